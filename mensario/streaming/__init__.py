"""Incremental landing of source files."""
