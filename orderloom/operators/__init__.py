"""Reusable DataFrame operators that stay safe on skewed keys."""
