"""Column expressions: keys, ratios, labels and the calendar."""
