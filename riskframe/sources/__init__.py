"""Readers, writers and source manifests."""
