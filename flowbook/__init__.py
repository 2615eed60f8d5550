"""flowbook: reports on financial positions and flows, written as Spark DataFrame jobs."""
