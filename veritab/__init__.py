"""A PySpark-native engine for reconciling and checking document-derived tables."""
