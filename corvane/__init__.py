"""corvane: a Spark-native engine for entity resolution and ownership graphs."""

__version__ = "0.1.0"
