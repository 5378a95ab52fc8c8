"""Queries over the driver tables: derived booking tables, Spark plans and SQL oracles."""
