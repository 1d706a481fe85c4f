"""Layered analytical tables on Spark: landing, quality gates, keyed merges, change streams, features."""
