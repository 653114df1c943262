"""Readers, sinks and intermediate tables."""
