"""skiff — Spark-native batch and streaming analytics operators.

Sub-packages:

* ``sources``   — readers (parquet tables, CSV, JDBC, Kafka options, file streams)
                  and the fixture views derived from the driver tables.
* ``functions`` — column-expression helpers (threshold bands, exact rounding,
                  Python-style time text).
* ``operators`` — DataFrame operators: cleaning, data quality, marts, windows,
                  trip enrichment, AQI messages and windows, serving queries.
* ``sinks``     — table publishing, idempotent keyed upsert log, retention.
* ``streaming`` — Structured Streaming jobs wiring sources → operators → sinks.
* ``plans``     — the named contract queries ``(spark, sf_dir) -> DataFrame``.
"""

__version__ = "0.1.0"
