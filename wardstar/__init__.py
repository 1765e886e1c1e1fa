"""wardstar: a Spark-native clinical star-schema warehouse (see README.md)."""
