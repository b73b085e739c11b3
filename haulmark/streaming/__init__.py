"""Structured Streaming: event decoding, enrichment and the idempotent sink."""
