"""Utility reliability and storm-risk analytics as PySpark operators and pipelines."""
