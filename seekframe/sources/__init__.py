"""Readers and writers for corpora, vector tables and their exports."""
