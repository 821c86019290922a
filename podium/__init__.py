"""Podium: layered batch pipelines and streaming enrichment on Spark.

Every function takes a ``SparkSession`` or a DataFrame and gives back a
DataFrame or a ``StreamingQuery``. Nothing in the library makes a session or
sets a master.
"""
