"""stridelake: a Spark-native engine for skeletal-motion data and training-data upkeep."""
