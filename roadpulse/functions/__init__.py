"""Column expressions. All of them stay in the JVM; none is a Python UDF."""
