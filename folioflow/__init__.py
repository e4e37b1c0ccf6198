"""Document-table operators for PySpark."""
