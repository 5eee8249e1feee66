"""Structured Streaming jobs built from the same transform functions."""
