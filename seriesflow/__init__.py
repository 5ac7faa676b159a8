"""Layered pipelines over economic time series on Spark."""
