"""Access-log analytics as Spark DataFrame jobs.

``functions``  column expressions (no I/O, no Python UDFs)
``sources``    DataFrames of raw lines
``operators``  DataFrame -> DataFrame steps: parse, enrich, count, rank, report
``sinks``      catalog tables, staged and audited writes
``plans``      the end-to-end batch load
"""
