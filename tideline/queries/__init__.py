"""Registered queries on the driver tables, one module per group of operators."""
