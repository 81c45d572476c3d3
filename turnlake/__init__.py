"""Prompt-log analytics as PySpark DataFrame jobs."""
