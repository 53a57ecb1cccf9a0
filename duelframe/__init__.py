"""Encounter analytics on Spark: two sides, a date, a score, optional prices."""
