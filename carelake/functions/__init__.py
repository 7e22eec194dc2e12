"""Column expressions shared by the operators; all run on Spark's built-in functions."""
