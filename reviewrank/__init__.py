"""Ranks insurance claims for human review, as Spark DataFrame transforms."""
