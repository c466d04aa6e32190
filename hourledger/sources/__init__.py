"""Readers. Schemas are explicit; files are listed by Spark."""
