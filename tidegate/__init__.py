"""Master-data migration and incremental sync as Spark DataFrame operators."""

__version__ = "0.1.0"
