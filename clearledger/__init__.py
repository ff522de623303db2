"""Paid-claims analytics as Spark DataFrame jobs."""
