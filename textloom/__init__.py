"""textloom: document analytics, concept linking and corpus preparation on PySpark."""

__version__ = "0.1.0"
