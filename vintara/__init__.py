"""Conformed incident analytics as plain DataFrame operators on Spark."""

__version__ = "0.1.0"
