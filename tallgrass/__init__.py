"""Tallgrass: a PySpark engine for monthly production data and training-data pipelines."""
