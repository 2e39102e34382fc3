"""Readers: each one returns a DataFrame in the canonical record schema."""
