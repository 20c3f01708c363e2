"""A Spark-native engine for building and auditing parallel-text corpora."""
