"""fundlake: fund-data ingestion, statement extraction, position completion
and load verification as Spark DataFrame / SQL / Structured Streaming jobs."""

__version__ = "0.1.0"
