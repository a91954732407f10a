"""Operators for preparing training data at scale (one module per operator)."""
