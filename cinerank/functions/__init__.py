"""Column expressions shared by all jobs (built-in Spark functions only)."""
