"""creditloom.operators"""
