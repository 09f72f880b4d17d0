"""Readers, parsers of raw documents, and sinks."""
