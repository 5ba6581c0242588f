"""Layered data refinement on Spark: bronze -> silver -> gold with quality rules.

Every operator takes DataFrames and returns DataFrames built from Spark's own
expressions; nothing here runs Python code per row.
"""

__version__ = "0.1.0"
