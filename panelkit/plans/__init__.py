"""Silver, gold, inference, modelling, monitoring and governance builds composed from operators."""
