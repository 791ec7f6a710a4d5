"""A Spark-native engine that builds and queries a catalog of educational institutions."""
