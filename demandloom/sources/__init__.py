"""Readers, writers, file inventories and version manifests."""
