"""Retail order warehouse: raw logs and dimensions to detail, aggregate and report tables on Spark."""
