"""linkloom: a Spark-first record-linkage analytics engine."""
