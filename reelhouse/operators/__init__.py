"""Reusable DataFrame-to-DataFrame steps."""
