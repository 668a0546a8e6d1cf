"""linedocs: lines of text files and streams -> documents, counts and read-back,
built on Spark DataFrames and Structured Streaming."""

__version__ = "0.1.0"
