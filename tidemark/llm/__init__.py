"""Operators that prepare text corpora for the training of language models."""
