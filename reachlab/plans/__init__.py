"""Registered queries, the fixtures they run on, and content-keyed materialisation."""
