"""Market-data analytics on Spark SQL and Structured Streaming.

Every public function takes DataFrames and returns a DataFrame.  Column-level
rules live in ``functions``, relational operators in ``operators``, input and
output in ``sources``, unbounded inputs in ``streaming``, and the registered
queries over the driver's tables in ``plans``.
"""
