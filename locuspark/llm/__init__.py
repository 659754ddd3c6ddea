"""Operators for large training-data pipelines, each DataFrame in, DataFrame out."""
