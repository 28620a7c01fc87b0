"""A PySpark-native analytics engine for document-evidence registries."""
