"""A PySpark-native engine for registry and page-lifecycle analytics."""
