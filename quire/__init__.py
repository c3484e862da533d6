"""quire: a Spark-native engine that turns positioned document content into queryable structure."""

__version__ = "0.1.0"
