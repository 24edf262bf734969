"""Readers: event streams, tables, landed objects."""
