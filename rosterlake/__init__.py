"""Profile ingest, search and stream statistics as Spark DataFrame operators."""

__version__ = "0.1.0"
