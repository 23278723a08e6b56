"""A Spark-native engine for discovery, extraction and change capture of relational tables."""
