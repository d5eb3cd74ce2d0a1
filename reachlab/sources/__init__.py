"""Readers and writers of the table-shaped sources and sinks."""
