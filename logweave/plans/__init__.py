"""Registered queries (Spark jobs over the given tables) and their SQL oracles."""
