"""Operators that prepare text and score tables for model training; nothing outside imports this package."""
