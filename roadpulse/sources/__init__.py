"""Readers and writers: detection streams, JSON lines, published tables."""
