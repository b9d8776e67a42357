"""Delivery analytics on Spark: event feeds in, windowed analytics and reports out."""

__version__ = "0.1.0"
