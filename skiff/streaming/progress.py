"""Progress of streaming queries as a table: one JSON line per query and micro-batch.

A query listener writes what Spark measured for each micro-batch (input rows, rows
dropped by the watermark, ``observe`` metrics) to ``<root>/<query name>/batch-<n>.json``
in the shared folder, so counters survive the driver and are read back as a DataFrame.
A replayed batch rewrites its own file.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS = ("query string, batch_id bigint, rows_in bigint, groups_dropped bigint, watermark string, "
            "metrics map<string, map<string, bigint>>")


class ProgressTable(StreamingQueryListener):
    """Listener that stores the progress of the queries whose name starts with ``prefix``."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark, self.root, self.prefix = spark, root, prefix
        self._ended: dict[str, threading.Event] = {}
        spark.streams.addListener(self)

    def _end(self, run_id) -> threading.Event:
        return self._ended.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(event.runId)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(event.runId).set()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if not (p.name or "").startswith(self.prefix):
            return
        row = {
            "query": p.name, "batch_id": p.batchId, "rows_in": p.numInputRows,
            "groups_dropped": sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
            "watermark": (p.eventTime or {}).get("watermark"),
            "metrics": {name: m.asDict() for name, m in (p.observedMetrics or {}).items()},
        }
        if p.numInputRows or row["groups_dropped"]:  # a batch without data adds nothing
            self._write(f"{self.root}/{p.name}/batch-{p.batchId}.json", json.dumps(row))

    def _write(self, path: str, line: str) -> None:
        sc = self.spark.sparkContext
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        out = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target, True)
        try:
            out.write(bytearray((line + "\n").encode()))
        finally:
            out.close()

    def close(self, queries: list[StreamingQuery] = (), timeout_s: float = 60) -> None:
        """Wait until the last progress of the ended ``queries`` is stored, then stop listening."""
        for q in queries:
            if not self._end(q.runId).wait(timeout_s):
                raise TimeoutError(f"progress of {q.name} not stored within {timeout_s} s")
        self.spark.streams.removeListener(self)


def read_progress(spark: SparkSession, root: str) -> DataFrame:
    """query, batch_id, rows_in, groups_dropped, watermark and metrics of every stored batch."""
    return spark.read.schema(PROGRESS).json(f"{root}/*/*.json")


def observed(progress: DataFrame, name: str, *metrics: str) -> DataFrame:
    """Sums of a query's ``observe`` metrics over all batches, one column each."""
    return progress.agg(*[F.coalesce(F.sum(F.col("metrics")[name][m]), F.lit(0)).alias(m) for m in metrics])
