"""Operators for preparing training text: mixing, filtering, scoring, joining, encoding."""
