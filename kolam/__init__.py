"""kolam: a Spark-native engine for building quality-gated sentence and translation corpora."""
