"""Spark-native warehouse jobs for shop behaviour logs and database change records."""
