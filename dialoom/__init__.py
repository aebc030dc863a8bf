"""dialoom: a Spark-first engine for planning, reshaping, scoring and exporting dialogue data."""

__version__ = "0.1.0"
