"""Operators for preparing training text: scans, search, classifiers, duplicates, tokens."""
