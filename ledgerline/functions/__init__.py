"""Column expressions and the aggregate building blocks used by the operators."""
