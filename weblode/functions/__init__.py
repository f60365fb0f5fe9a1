"""Column expressions: URL, text, value and document-node functions."""
