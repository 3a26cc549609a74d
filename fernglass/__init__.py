"""A PySpark-native catalogue analytics engine: pure DataFrame -> DataFrame operators and a thin query registry."""
