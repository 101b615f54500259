"""Operators of a training-data pipeline: filters, near-duplicates, scoring, packing and roll-ups.

Nothing outside this subpackage imports it.
"""
