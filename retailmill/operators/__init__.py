"""Relational operators over bronze and curated tables."""
