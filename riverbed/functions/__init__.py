"""riverbed: Spark-native change-data analytics."""
