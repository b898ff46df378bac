"""Device-reading analytics expressed as Spark DataFrame plans."""
