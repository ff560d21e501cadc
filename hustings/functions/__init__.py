"""Column expressions: text folding, places, names, parties, offices."""
