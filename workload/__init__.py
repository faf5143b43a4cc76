"""The registered queries: stand-in tables over the given data, Spark side and SQL side."""
