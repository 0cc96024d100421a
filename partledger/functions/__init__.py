"""Column expressions: names, keys, times, digests, rules and JSON text."""
