"""cartmill: marketplace analytics expressed as Spark DataFrame jobs."""
