"""Column expressions: keys, time, text, coercion."""
