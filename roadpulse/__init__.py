"""Road-traffic analytics on PySpark: DataFrame -> DataFrame operators and two published pipelines."""
