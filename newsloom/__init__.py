"""newsloom: a PySpark-native engine for news-intelligence data."""
