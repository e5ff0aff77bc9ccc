"""Spark-first analytics for 4D spots, tracks and labelled voxel volumes."""

__version__ = "0.1.0"
