"""Operators over training text, pages and embeddings.

Each module holds one operator with its own general interface; ``queries``
binds them to the driver's tables.
"""
