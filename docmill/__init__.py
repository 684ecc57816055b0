"""docmill: a PySpark-native engine for records extracted from documents."""
