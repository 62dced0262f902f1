"""Operators for training-data pipelines: each is a Spark job over whole tables."""
