"""Whole jobs over many tables, put together from the operators."""
