"""Table operators: DataFrame -> DataFrame functions built from Spark primitives."""
