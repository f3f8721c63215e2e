"""Transaction feature enrichment as Spark DataFrame operators."""
