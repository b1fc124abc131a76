"""Column expressions: text, vectors, hashing."""
