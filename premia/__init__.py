"""Premia: price-premium analytics expressed as Spark DataFrame jobs."""
