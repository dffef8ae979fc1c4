"""Payments change-data and FX analytics on PySpark DataFrames."""
