"""Retail sales analytics as Spark DataFrame jobs: landing, cleansing, versioned facts, marts, reports."""

__version__ = "0.1.0"
