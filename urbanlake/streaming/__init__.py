"""urbanlake.streaming"""
