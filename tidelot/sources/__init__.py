"""Readers, payload parsing, the append-only store and sinks."""
