"""Retail demand analytics as PySpark DataFrame operators."""
