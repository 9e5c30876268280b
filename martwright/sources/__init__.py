"""Readers and writers: feed files, published snapshots, staging, catalog."""
