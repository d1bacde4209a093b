"""Sales forecasting on tables and streams, written as Spark jobs."""
