"""Analytics operators over case notifications and text, written for Spark.

``functions`` holds column expressions, ``operators`` holds DataFrame to
DataFrame operators, ``sources`` reads and writes tables, and ``plans`` binds
the operators to the shared test tables as named queries.
"""
