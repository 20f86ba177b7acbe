"""Readers and writers of corpus files, with explicit schemas."""
