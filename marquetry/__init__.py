"""A PySpark-native engine that prepares and audits multimodal episode data sets."""
