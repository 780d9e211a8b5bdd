"""Streaming use of the record plans."""
