"""Declared schemas, readers, source checks and sinks."""
