"""Column expressions: text, time, scoring. All run inside Spark's generated code."""
