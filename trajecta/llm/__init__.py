"""Operators for training text: tokenising, packing, grouped splits, abuse scoring.

Nothing outside this subpackage imports it.
"""
