"""creditloom.functions"""
