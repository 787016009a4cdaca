"""kinlink: a Spark-first record-linkage and entity-resolution engine."""

__version__ = "0.1.0"
