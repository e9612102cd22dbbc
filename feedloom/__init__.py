"""feedloom: content analytics for feeds, articles and documents on PySpark."""

__version__ = "0.1.0"
