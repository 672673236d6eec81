"""Column expressions: draws, vectors, names."""
