"""Operators for large text corpora: each is a plain function from DataFrame to DataFrame."""
