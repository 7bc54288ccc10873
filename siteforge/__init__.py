"""Spark-native analytics engine for locating, scoring and correcting facility sites."""
