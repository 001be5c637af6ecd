"""cyclemart: a PySpark-native engine for data that arrives in cycles.

Sub-packages:

* ``sources``   – file discovery, CSV / encrypted CSV ingest, staged Parquet, reports,
                  versioned publish.
* ``functions`` – column-level helpers (predicates, object-key parsing, encryption).
* ``operators`` – DataFrame -> DataFrame operators: filters, joins, dedup, aggregates,
                  quality rules, SCD Type 1 merge, arrival audit.
* ``streaming`` – Structured Streaming: arrival stream, emit-once cycle gate, alarms.
* ``plans``     – end-to-end jobs and the query catalogue run on the driver tables.
"""

__version__ = "0.1.0"
