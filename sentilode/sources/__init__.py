"""Readers and writers for corpora, message logs and scored results."""
