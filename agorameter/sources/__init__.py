"""Readers: relational tables, JSON and text files, message topics."""
