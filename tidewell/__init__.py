"""Tidewell: batch delivery, version history and data quality on Spark."""
