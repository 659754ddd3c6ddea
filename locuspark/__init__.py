"""Genomic interval analytics on PySpark."""
