"""A PySpark-native engine that indexes, searches and summarises large collections of log events."""
