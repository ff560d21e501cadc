"""hustings: longitudinal results data on PySpark DataFrames."""
