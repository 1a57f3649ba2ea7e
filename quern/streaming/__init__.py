"""Streaming forms of the validation and daily monitoring operators."""
