"""Incremental landing of newly delivered files."""
