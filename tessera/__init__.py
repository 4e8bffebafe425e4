"""tessera: data-engineering jobs as DataFrame -> DataFrame functions on Spark.

Subpackages
-----------
sources    scans, sinks, load jobs and load audit (SRC-*, LOAD-*)
functions  Column-level helpers: scalar, date, text and list expressions (SCL-*)
operators  relational jobs: joins, aggregates, windows, sequences, sets,
           semi-structured, warehouse modelling, versions, text, vectors,
           quality, sampling, layout, evaluation (JOIN-*, AGG-*, ...)
streaming  Structured Streaming jobs (STR-*)
plans      the query registry checked against SQL oracles, plan checks
"""

from tessera.session import get_session, load_table, tables

__all__ = ["get_session", "load_table", "tables"]
