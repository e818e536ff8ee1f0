"""Retail order analytics as plain DataFrame -> DataFrame functions on PySpark."""
