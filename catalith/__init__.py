"""Catalith: a Spark-native metadata catalogue, concept-graph and retrieval library.

Every operator takes DataFrames (or Columns) and returns DataFrames (or Columns);
nothing here starts its own session or reads data a caller did not pass in.
"""

__version__ = "0.1.0"
