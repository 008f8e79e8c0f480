"""Estimators (fit = distributed aggregation, score = projection) and query plans."""
