"""laminar: a layered daily warehouse (raw -> detail -> summary -> serving, plus
dimensions and data-quality checks) built on Spark DataFrames, SQL and
Structured Streaming."""

__version__ = "0.1.0"
