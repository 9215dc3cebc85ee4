"""Readers and writers for files, topics and structured payloads."""
