"""Tabulith: tabular profiling, preparation and model analytics on Spark DataFrames.

Every operator takes a DataFrame and column names and returns a DataFrame.
Operators are lazy unless their docstring says that they run a job.
"""

__version__ = "0.1.0"
