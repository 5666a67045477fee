"""Layered trip-record analytics on Spark DataFrames."""
