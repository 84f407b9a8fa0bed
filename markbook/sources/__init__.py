"""Readers for landed JSON pages and reference tables, and the write modes of the stored tables."""
