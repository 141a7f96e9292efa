"""heartspark: survey analytics (ETL, star schema, measures, statistics, models,
mining and scoring) as Spark DataFrame, SQL and ML jobs."""

__version__ = "0.1.0"
