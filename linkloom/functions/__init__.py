"""Column factories and Arrow UDFs."""
