"""Policy warehouse jobs on Spark: clean regional feeds, keep history, link facts, answer reports."""
