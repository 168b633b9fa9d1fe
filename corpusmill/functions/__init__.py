"""Column expressions and small helpers that operators share."""
