"""Retail and paid-media analytics as plain PySpark DataFrame functions."""
