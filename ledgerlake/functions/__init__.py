"""Column expressions: text and key helpers, vector arithmetic."""
