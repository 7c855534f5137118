"""Composed plans: feature matrices, reports, MLlib training."""
