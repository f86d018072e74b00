"""Operators for preparing training text: deduplication, screening, scoring, tokenising and packing.

Nothing outside this subpackage imports it, except the driver's entry file, behind a guard.
"""
