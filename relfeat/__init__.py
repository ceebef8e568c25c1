"""Relational feature engineering and scorecard evaluation as Spark jobs."""
