"""The jobs, each from landed files or tables to written tables."""
