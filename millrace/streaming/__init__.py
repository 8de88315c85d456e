"""Structured Streaming: runners and a keyed upsert sink."""
