"""Operators that prepare text, vectors and media for training corpora."""
