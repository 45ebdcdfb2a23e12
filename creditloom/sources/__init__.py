"""creditloom.sources"""
