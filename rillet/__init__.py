"""rillet: event analytics on Spark SQL.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions, so Catalyst plans it and whole-stage codegen runs it.  Keyed
running operators are expressed as chunked prefix scans so that a single hot
key never has to fit in one task.
"""

__version__ = "0.1.0"
