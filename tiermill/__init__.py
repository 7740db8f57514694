"""Layered-warehouse toolkit for PySpark: ingest, validate, clean, conform, track changes, compute metrics, deliver."""

__version__ = "0.1.0"
