"""tracewright: a Spark-native engine for turning semi-structured documents into traceable, queryable knowledge."""

__version__ = "0.1.0"
