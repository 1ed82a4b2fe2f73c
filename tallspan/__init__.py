"""Spark-native engine that turns sparse, versioned wide-column cells into tall analytical tables."""
