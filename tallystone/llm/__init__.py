"""Operators for preparing training data: documents, conversations and embeddings."""
