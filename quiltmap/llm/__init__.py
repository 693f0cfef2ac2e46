"""Operators for preparing training text, one module each, and the queries that apply them."""
