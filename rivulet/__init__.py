"""Spark-native jobs for text, graph, event-time and numeric data, as DataFrame functions."""
