"""DataFrame-to-DataFrame analytics operators for Spark.

Sub-packages: ``sources`` (scans and sinks), ``functions`` (Column in, Column out), ``operators`` (DataFrame in,
DataFrame out), ``models`` (fits, metrics, tuning) and ``plans`` (registered queries with their SQL twins).
"""
