"""Readers, writers and the views that shape given tables into transactions."""
