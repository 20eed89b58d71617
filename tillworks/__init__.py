"""Point-of-sale analytics on Spark: raw lines to a star schema, in batch and on a stream.

Every operator is a function from DataFrame to DataFrame built on Spark's own
expressions. Sessions, masters and cluster sizes belong to the caller.
"""
