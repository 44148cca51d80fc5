"""Scored-games lakehouse on Spark: raw pages, typed tables, marts and checks."""
