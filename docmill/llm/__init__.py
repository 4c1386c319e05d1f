"""Operators for preparing training data: tokens, duplicates, archives, filters, mixing, scoring."""
