"""Spark-native analytics for fleets of connected appliances."""
