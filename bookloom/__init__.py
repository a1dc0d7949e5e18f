"""Spark-native analytics for very large document and e-book collections."""
