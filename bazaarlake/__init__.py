"""Retail warehouse and behaviour analytics as PySpark DataFrame operators."""
