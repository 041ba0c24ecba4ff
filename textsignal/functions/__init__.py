"""Column expressions: no shuffle, no driver work."""
