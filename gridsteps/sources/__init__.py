"""Readers and writers: tables, metadata, file inventories, flat grid files."""
