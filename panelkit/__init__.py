"""Snapshot-panel and feature-store operators as PySpark DataFrame functions."""
