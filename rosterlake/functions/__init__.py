"""Column expressions: parsing, tokens, wire codec, geometry, labels and display."""
