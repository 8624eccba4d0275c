"""urbanlake.functions"""
