"""Column expressions (dates, ratios, text) used by the operators."""
