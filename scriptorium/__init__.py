"""Corpus analytics and training-data preparation on Spark DataFrames.

Sub-packages:
  functions  Column -> Column expressions (text normalisation, tokens, hashing)
  sources    readers and writers (binary text files, CSV, JSON, partitioned splits)
  operators  DataFrame -> DataFrame operators (statistics, chunking, splits, metrics ...)
  plans      end-to-end jobs composed from operators, and the registered queries
  streaming  the row-local operators wired to Structured Streaming
"""

__version__ = "0.1.0"
