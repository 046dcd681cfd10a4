"""Gridded environmental measurements to region-day feature tables, on Spark."""

__version__ = "0.1.0"
