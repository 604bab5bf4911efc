"""Slotweave: a Spark-native engine for fixed-interval count series and the data pipelines around it."""
