"""Operators for preparing training text: cleaning, near duplicates, tokens, archives."""
