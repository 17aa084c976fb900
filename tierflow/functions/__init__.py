"""Column expressions: keys, masks, parsing, ratios."""
