"""Operators for building training data from documents, pages, conversations and embeddings.

Nothing else in the library imports this subpackage; it uses only the library's general helpers.
"""
