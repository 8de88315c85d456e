"""Readers: files, catalog tables and streams."""
