"""Incremental silver loads driven by new bronze files (Structured Streaming)."""
