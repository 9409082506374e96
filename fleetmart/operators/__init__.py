"""Operators that stay balanced when one key or one value dominates."""
