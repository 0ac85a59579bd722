"""Housing-permit analytics as Spark DataFrame transformations."""
