"""landquill: land valuation analytics expressed as Spark DataFrame jobs."""
