"""Batch refinement on Spark: conform, filter, de-duplicate, star schema, roll-ups, checks, publish."""
