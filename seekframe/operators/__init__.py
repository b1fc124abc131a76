"""Operators from DataFrame to DataFrame: chunking, indexing, search, fusion."""
