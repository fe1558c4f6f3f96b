"""tidewake: Spark-native analytics for at-least-once event logs."""
