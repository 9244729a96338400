"""Readers for instrument text, side tables and level tables, and their sinks."""
