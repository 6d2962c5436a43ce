"""Reusable column expressions (all built-in Spark SQL functions)."""
