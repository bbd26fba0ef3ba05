"""corpusmill: a PySpark-native store and analytics engine for offline documentation corpora."""

__version__ = "0.1.0"
