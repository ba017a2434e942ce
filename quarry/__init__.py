"""quarry: search and relevance analytics composed from Spark DataFrame operators."""

__version__ = "0.1.0"
