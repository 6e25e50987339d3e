"""Operators for preparing training data: grouped splits, packing, leakage and truncation."""
