"""Column functions: every one takes and returns a Spark Column, none is a Python UDF."""
