"""Prepare, profile and judge labelled text tables as Spark jobs."""

__version__ = "0.1.0"
