"""Relational operators: DataFrame in, lazy DataFrame out."""
