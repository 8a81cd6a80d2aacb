"""Indicator analytics on PySpark.

Landing files -> bronze -> silver -> gold -> statistics, chart tables and a
geometry-enriched serving table, written as DataFrame operators.
"""
