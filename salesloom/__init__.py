"""Retail warehouse and KPI analytics as Spark DataFrame jobs."""
