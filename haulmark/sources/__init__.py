"""Readers and writers: raw zone, object keys, lake tables, event streams."""
