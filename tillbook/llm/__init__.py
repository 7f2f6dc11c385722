"""Operators for preparing training data: filters, near-duplicate detection, scoring, mixing and packing."""
