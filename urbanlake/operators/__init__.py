"""urbanlake.operators"""
