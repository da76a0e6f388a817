"""Column expressions: cleaning text, checking numbers, rounded averages."""
