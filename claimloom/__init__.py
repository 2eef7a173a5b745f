"""Claims analytics on Spark: feeds, star-schema warehouse, KPI reports and quality gates."""

__version__ = "0.1.0"
