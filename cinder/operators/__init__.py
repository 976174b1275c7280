"""Query operators: DataFrame -> DataFrame, built from Spark SQL expressions."""
