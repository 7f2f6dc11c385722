"""The package's queries on the given tables, and the same queries as SQL to compare them with."""
