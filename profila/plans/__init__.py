"""Composed plans: the device feature table, the gender and age stages and
the end-to-end result."""
