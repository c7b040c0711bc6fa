"""Readers for message topics, files and the driver tables."""
