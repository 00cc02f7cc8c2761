"""Data-dictionary and profiling operators written as Spark DataFrame plans."""

__version__ = "0.1.0"
