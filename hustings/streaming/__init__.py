"""Incremental landing of result files."""
