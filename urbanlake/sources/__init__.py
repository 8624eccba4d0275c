"""urbanlake.sources"""
