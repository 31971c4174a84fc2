"""Payment-card analytics as Spark DataFrame functions."""
