"""Composable, lazy ``DataFrame -> DataFrame`` operators for Spark.

Subpackages: ``sources`` (readers, writers, catalog), ``functions`` (column
expressions), ``operators`` (whole-frame operators) and ``plans`` (the query
catalogue with its SQL oracles).
"""
