"""Signal and reference-table analytics as Spark DataFrame jobs."""
