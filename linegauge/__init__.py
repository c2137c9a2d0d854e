"""linegauge: manufacturing quality and scrap analytics as Spark DataFrame jobs."""
