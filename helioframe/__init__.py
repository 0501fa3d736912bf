"""helioframe: sensor time-series ingestion, aggregation and model training on Spark."""

__version__ = "0.1.0"
