"""bidlines: line items out of public tender notices, as Spark DataFrame jobs."""
