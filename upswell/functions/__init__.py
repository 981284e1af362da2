"""Column expressions; every one is native Spark SQL, none calls Python per row."""
