"""Structured Streaming jobs over the same operators the batch plans use."""
