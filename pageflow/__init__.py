"""pageflow: page-creation analytics on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
built-ins, so the same code serves batch reads and Structured Streaming.
"""

__version__ = "0.1.0"
