"""Scoring, monitoring and governance of binary-outcome models as Spark jobs."""
