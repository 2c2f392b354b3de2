"""Column builders: keyed randomness, mixed-radix cells, privacy formulas."""
