"""inkwell: a PySpark-native engine for large text corpora."""
