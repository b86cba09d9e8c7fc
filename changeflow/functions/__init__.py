"""Column expressions: text codecs, masking and regular expressions."""
