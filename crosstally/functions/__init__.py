"""Column expressions: exact money arithmetic and calendar parsing."""
