"""Queries that run the library over the driver's tables, with their SQL."""
