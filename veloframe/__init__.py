"""A Spark-native engine for keyed, timed measurements: ingest, window analytics, quality rules and evidence."""
