"""sievework: Spark-native operators for auditing, deduplicating and curating datasets."""
