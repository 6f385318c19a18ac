"""Readers and writers: datasets, channels, registry."""
