"""Operators for large text corpora: each module is one operator over a documents table."""
