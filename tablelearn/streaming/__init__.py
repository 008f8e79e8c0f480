"""Scoring fitted models over Structured Streaming sources."""
