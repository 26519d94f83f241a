"""loomline: a PySpark-native engine for pipeline metadata and data lineage."""
