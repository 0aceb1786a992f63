"""Column functions: scores, hash draws, vectors."""
