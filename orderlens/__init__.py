"""Order analytics on Spark: change streams, a star schema with history, and tip models."""
