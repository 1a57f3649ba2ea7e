"""Readers, writers, manifests and the ingestion log."""
