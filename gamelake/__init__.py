"""Game-log and event analytics as plain Spark DataFrame functions."""
