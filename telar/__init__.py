"""telar: a Spark-native corpus retrieval and text processing engine."""
