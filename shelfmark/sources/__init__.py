"""Readers, writers and the dataset registry."""
