"""Incremental pick-up of newly landed pages."""
