"""Column-expression builders; nothing here triggers a job."""
