"""General operators: ``DataFrame -> DataFrame`` with column names as parameters."""
