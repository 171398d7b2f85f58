"""Operators of a training-data pipeline over document tables, each a Spark job over whole tables and whole texts."""
