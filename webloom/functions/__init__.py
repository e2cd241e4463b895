"""Column functions: expressions over Spark columns, no joins and no shuffles."""
