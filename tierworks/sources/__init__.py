"""Readers, incremental loads and writers."""
