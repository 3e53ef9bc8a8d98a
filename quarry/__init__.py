"""quarry: a PySpark-native engine for building and querying searchable text collections."""

__version__ = "0.1.0"
