"""Operators: quality evaluation, the high-water mark and the gold joins."""
