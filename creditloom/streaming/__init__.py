"""creditloom.streaming"""
