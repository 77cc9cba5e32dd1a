"""Whole loads and analyses composed from the operators."""
