"""Operators for training data: language, quality, duplicates, leaks, chats, pages, vectors, mixing.

Nothing else in the package imports this subpackage.
"""
