"""Supervised analytics on Spark tables: features, splits, models and evaluation as DataFrame operators."""
