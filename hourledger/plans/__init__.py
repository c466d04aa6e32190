"""Whole plans: table registry, pipeline, driver queries."""
