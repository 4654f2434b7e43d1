"""Column-level helpers (return ``Column``), built from Spark SQL functions."""
