"""Spark-native entity resolution, ownership analytics and data preparation.

Every operator is a function from DataFrames to a DataFrame. Sessions, paths
and sinks appear only in ``sources`` and in the query catalogues of ``plans``.
"""

__version__ = "0.1.0"
