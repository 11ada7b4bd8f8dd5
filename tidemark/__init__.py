"""tidemark: operational metrics on Spark.

Compressed batches of JSON events become one row per metric, enriched from
small dictionaries, kept as a keyed table and rolled up over sliding windows.
Every step is a DataFrame -> DataFrame function used by batch and streaming.
"""
