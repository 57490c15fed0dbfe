"""Column expressions: codecs, curve loadings, cash flows."""
