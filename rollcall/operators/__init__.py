"""Relational operators of a zone run, each a DataFrame transformation."""
