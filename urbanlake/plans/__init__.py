"""urbanlake.plans"""
