"""Evaluation analytics on Spark: events, measurements, windows, catalogues, audit chains."""
