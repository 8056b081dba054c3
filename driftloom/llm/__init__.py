"""Operators that prepare text, pages, vectors and dialogues for model training."""
