"""Registered queries: each operator on the driver's tables, with an independent SQL form."""
