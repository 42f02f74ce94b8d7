"""Trajecta: a PySpark-native engine for nested run records and iteration trajectories."""

__version__ = "0.1.0"
