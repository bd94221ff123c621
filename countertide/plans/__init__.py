"""Reusable physical building blocks: shared tables, ordered slices, skew-safe joins."""
