"""Operators that prepare text for training: duplicates, survivors, caps, encoding, leakage and languages."""
