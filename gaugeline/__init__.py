"""Spark-native indicator analytics and retrieval.

Every operator is a function from DataFrames to a DataFrame. Nothing here runs
its own engine: the logical plan is declared with the DataFrame API and Spark
chooses the physical strategy.
"""

__version__ = "0.1.0"
