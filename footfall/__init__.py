"""Web and commerce analytics as Spark DataFrame jobs.

Every operator is a function from DataFrames to a DataFrame.  Nothing in the
batch part of the package runs a job by itself: plans are built lazily and the
caller decides where they end (a table, a file, the next operator).
"""

__version__ = "0.1.0"
