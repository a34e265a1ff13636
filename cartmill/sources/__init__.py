"""Readers and writers: raw CSV entities, managed tables and gold extracts."""
