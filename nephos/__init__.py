"""Observation, ensemble and corpus analytics expressed as Spark DataFrame plans."""
