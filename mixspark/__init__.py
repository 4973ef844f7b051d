"""A Spark-native engine for abundance estimation and corpus preparation."""
