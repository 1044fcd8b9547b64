"""Whole monthly runs."""
