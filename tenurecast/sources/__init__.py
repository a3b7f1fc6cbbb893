"""Readers, writers and the stand-in feature table."""
