"""Migrate raw tabular files into contract-checked tables and query them, on Spark."""

__version__ = "0.1.0"
