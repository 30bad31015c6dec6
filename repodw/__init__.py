"""repodw: a Spark-native warehouse for open-source repository metrics."""
