"""Operators that prepare training text: archives, cleaning, near duplicates, mixing, tokens."""
