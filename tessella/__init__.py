"""Tessella: a Spark-native analytics engine for slide -> tile -> cell data."""

__version__ = "0.1.0"
