"""Structured Streaming variants: CDC upsert, streaming alignment, absence state."""
