"""kinfold: a Spark-native engine that finds, scores, clusters and merges duplicate records."""
