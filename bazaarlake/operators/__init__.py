"""Warehouse operators: DataFrames and a business date in, a lazy DataFrame out."""
