"""A Spark-native engine for building, curating and auditing training data."""
