"""saleslake: a Spark-native daily retail sales warehouse.

Every operator is a function from DataFrames to DataFrames built on Spark SQL
expressions, joins, aggregates and windows.  Catalyst plans the whole chain;
writes are the only actions.
"""

__version__ = "0.1.0"
