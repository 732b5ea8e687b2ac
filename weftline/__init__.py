"""weftline: strict entity feeds, nested enrichment and data preparation on PySpark."""

__version__ = "0.1.0"
