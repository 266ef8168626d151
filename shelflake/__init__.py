"""shelflake: ranked product listings, from raw responses to a warehouse table, on Spark.

Everything here is a ``DataFrame -> DataFrame`` function or a thin job around one.
No UDFs, no RDDs: each expression is a built-in Spark function.
"""
