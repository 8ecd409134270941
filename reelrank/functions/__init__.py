"""Column expressions: calendar, text and list, scoring."""
