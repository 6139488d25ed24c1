"""Structured Streaming: JSON messages in, counts, distinct samples, filtered rows and loads out."""
