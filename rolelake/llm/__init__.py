"""Operators that prepare documents, pages and conversations for training language models."""
