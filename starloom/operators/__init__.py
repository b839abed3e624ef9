"""Warehouse operators: each is a DataFrame -> DataFrame function on
built-in Spark expressions."""
