"""Job-scoped review stream analytics on Spark DataFrames.

Every operator takes DataFrames and returns a DataFrame, so the same code runs
on batch tables and, where Structured Streaming allows the plan, on streams.
"""

__version__ = "0.1.0"
