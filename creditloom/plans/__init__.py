"""creditloom.plans"""
