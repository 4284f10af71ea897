"""Commerce lake analytics expressed as Spark DataFrame transformations."""
