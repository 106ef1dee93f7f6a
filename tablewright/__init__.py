"""Spark-native preparation, enrichment and model selection for tables."""

from tablewright import functions, operators, plans, sources

__all__ = ["functions", "operators", "plans", "sources"]
