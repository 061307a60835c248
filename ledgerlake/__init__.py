"""Versioned lakehouse operators for plain PySpark: DataFrame in, DataFrame out."""
