"""Spark-first engine for collecting, cleaning and analysing web content."""
