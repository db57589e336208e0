"""Spark-native operators for large collections of node time series and the tables around them."""
