"""The registered queries: operators bound to the given tables, each with SQL that states the same result."""
