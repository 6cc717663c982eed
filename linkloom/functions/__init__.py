"""Column functions: normalisation and similarity."""
