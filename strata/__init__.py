"""Layered (landing -> raw -> curated -> enriched) analytics jobs on Spark."""
