"""Disaster declarations and news articles as Spark DataFrame jobs.

``functions``  Column -> Column expressions, all JVM-side
``sources``    readers for landed CSV, NDJSON and payload files
``sinks``      writers
``operators``  DataFrame -> DataFrame building blocks (joins, dedup, ranking)
``plans``      the four jobs: counties, spine, articles, keys, and the crawl manifest
``streaming``  Structured Streaming forms of the spine and of the URL dedup
``catalog``    the queries the driver checks against SQL
"""
