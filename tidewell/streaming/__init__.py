"""Structured Streaming forms of validation and roll-up."""
