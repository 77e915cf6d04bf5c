"""Spark-native analytics over append-only archives of captured news and feeds."""
