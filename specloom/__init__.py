"""specloom: product-specification analytics as Spark DataFrame jobs."""
