"""Column -> Column helpers.  Every function here returns a built-in Spark
expression (no Python UDF), so it stays inside whole-stage codegen."""
