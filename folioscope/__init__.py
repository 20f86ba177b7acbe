"""A Spark-native engine for building, reconciling and searching a versioned text corpus."""
