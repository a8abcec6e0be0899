"""Column expressions: text, time, cleaning and scoring."""
