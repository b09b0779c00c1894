import datetime as dt
import glob
import json
from decimal import Decimal
import os
import time

import pytest
from pyspark.sql import functions as F

from skiff.sinks import keyed
from skiff.sources.files import json_file_source
from skiff.streaming.aqi_job import AqiStreamConfig, await_all, start_aqi_queries


def _write_batches(path, batches):
    """One JSON-lines file per batch, with strictly increasing modification times."""
    os.makedirs(path, exist_ok=True)
    base = time.time() - 1000
    for i, rows in enumerate(batches):
        f = os.path.join(path, f"part-{i:04d}.json")
        with open(f, "w") as fh:
            for r in rows:
                fh.write(json.dumps(r) + "\n")
        os.utime(f, (base + i, base + i))


def _msg(state, aqi, ts):
    return {"state": state, "aqi": aqi, "timestamp": ts}


def _run(spark, inp, run, cfg=None):
    cfg = cfg or AqiStreamConfig(trigger={"availableNow": True})
    qs = start_aqi_queries(spark, lambda: json_file_source(spark, inp, 1), f"{run}/out", f"{run}/ckpt", cfg)
    await_all(qs)
    return qs


def test_late_rows_update_then_drop(spark, tmp_dir):
    inp = f"{tmp_dir}/in"
    _write_batches(
        inp,
        [
            [_msg("A", 10.0, 1000)],  # window [990, 1020)
            [_msg("A", 20.0, 1200)],  # watermark → 1190 after this batch
            [_msg("A", 30.0, 995)],  # late; filtered with the previous batch's watermark → kept
            [_msg("A", 40.0, 996)],  # late and now beyond the watermark → dropped
        ],
    )
    qs = _run(spark, inp, f"{tmp_dir}/run")
    root = f"{tmp_dir}/run/out/window_log"
    log = keyed.read_log(spark, root)
    latest = {r.window_ts: r for r in keyed.latest(log).collect()}
    assert latest[990].record_count == 2 and latest[990].avg_aqi == 20.0
    assert latest[1200].record_count == 1
    current = {r.window_ts: (r.record_count, r.avg_aqi) for r in keyed.current(spark, root).collect()}
    assert current == {k: (r.record_count, r.avg_aqi) for k, r in latest.items()}
    dropped = sum(
        op.get("numRowsDroppedByWatermark", 0)
        for p in qs[0].recentProgress
        for op in p.get("stateOperators", []) if p
    )
    assert dropped == 1
    # emitted counters add every emission of window 990 (1 then 2)
    emitted = {r.band: r["count"] for r in keyed.band_counts(log).collect()}
    exact = {r.band: r["count"] for r in keyed.band_counts(keyed.latest(log)).collect()}
    assert emitted["Good"] == 4 and exact["Good"] == 3


def test_restart_resumes_from_checkpoint(spark, tmp_dir):
    inp, run = f"{tmp_dir}/in", f"{tmp_dir}/run"
    _write_batches(inp, [[_msg("A", 10.0, 100)], [_msg("A", 20.0, 105)]])
    _run(spark, inp, run)
    # a new file arrives while the job is down; the restarted job reads only it
    f = os.path.join(inp, "part-0009.json")
    with open(f, "w") as fh:
        fh.write(json.dumps(_msg("A", 30.0, 110)) + "\n")
    _run(spark, inp, run)
    log = keyed.read_log(spark, f"{run}/out/window_log")
    r = keyed.latest(log).filter("window_ts = 90").first()
    assert r.record_count == 3 and r.avg_aqi == 20.0
    assert log.select("batch_id").distinct().count() == 3


def test_replayed_batch_is_idempotent_and_empty_batch_skipped(spark, tmp_dir):
    root = f"{tmp_dir}/log"
    write = keyed.log_writer(root, F.col("k"), ["k", "v"], day=F.lit("2024-01-01").cast("date"))
    batch = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    write(batch, 0)
    write(batch, 0)  # replay of the same batch id rewrites, never duplicates
    write(spark.createDataFrame([], "k string, v int"), 1)
    assert not os.path.exists(f"{root}/day=2024-01-01/batch_id=1")
    log = keyed.read_log(spark, root)
    assert log.count() == 2
    write(spark.createDataFrame([("a", 5)], "k string, v int"), 2)
    assert {r.key: r.v for r in keyed.latest(keyed.read_log(spark, root)).collect()} == {"a": 5, "b": 2}


def test_retention_feed_and_expiry(spark):
    log = spark.createDataFrame(
        [
            (0, "k1", "A", 10.0, "Good", 1, 100),
            (0, "k2", "B", 20.0, "Good", 1, 200),
            (1, "k3", "A", 60.0, "Moderate", 2, 200),
            (1, "k1", "A", 11.0, "Good", 2, 100),
        ],
        "batch_id int, key string, state string, avg_aqi double, band string, record_count long, window_ts long",
    ).withColumn("window_start", F.timestamp_seconds("window_ts")).withColumn(
        "updated_at", F.when(F.col("batch_id") == 0, F.lit("2024-01-01 00:00:00")).otherwise(
            F.lit("2024-01-01 02:00:00")).cast("timestamp"))
    top = [r.key for r in keyed.retain_latest(keyed.latest(log), 2).collect()]
    assert top == ["k3", "k2"]  # equal scores: greater key first
    feed = keyed.read_feed(keyed.feed(log, 100), 3).collect()
    assert [(r.state, r.avg_aqi) for r in feed] == [("A", 60.0), ("A", 11.0), ("B", 20.0)]
    bad = spark.createDataFrame([(9, 900, "Z", "not json"), (9, 899, "Z", "[1]"), (8, 1, "Z", '{"state":"Z","avg_aqi":1.5}')],
                                "batch_id int, window_ts long, state string, entry string")
    assert [(r.state, r.avg_aqi, r.band) for r in keyed.read_feed(bad, 3).collect()] == [("Z", 1.5, None)]  # bad entries are skipped
    now = F.lit("2024-01-01 02:30:00").cast("timestamp")
    alive = {r.key for r in keyed.expire(keyed.latest(log), 3600, now).collect()}
    assert alive == {"k1", "k3"}


def test_trip_stream_counters(spark, tmp_dir):
    from skiff.operators import trips as T
    from skiff.streaming.trips_job import FLOW_METRICS, read_enriched, start_trip_query

    inp = f"{tmp_dir}/in"
    good = {"trip_id": 1, "pickup_datetime": "2024-01-01 00:00:00", "dropoff_datetime": "2024-01-01 00:10:00",
            "passenger_count": 1, "trip_distance": 2.0, "fare_amount": 12.5, "payment_type": "Cash"}
    _write_batches(inp, [[good, {"trip_id": 2, "trip_distance": 1.0}]])
    with open(os.path.join(inp, "part-0005.json"), "w") as fh:
        fh.write("not json\n")
    q = start_trip_query(spark, lambda: json_file_source(spark, inp), f"{tmp_dir}/out", f"{tmp_dir}/ckpt",
                         trigger={"availableNow": True})
    await_all([q])
    metrics = [p["observedMetrics"][FLOW_METRICS] for p in q.recentProgress if p.get("observedMetrics")]
    total = {k: sum(int(m[k]) for m in metrics) for k in ("consumed", "enriched", "enrich_errors")}
    assert total == {"consumed": 3, "enriched": 1, "enrich_errors": 2}
    enriched = read_enriched(spark, f"{tmp_dir}/out").collect()
    assert [(r.trip_id, float(r.speed_mph)) for r in enriched] == [(1, 12.0)]
    assert spark.read.parquet(f"{tmp_dir}/out/rejects").count() == 2
    from skiff.sinks.points import stored_points
    pts = stored_points(spark, f"{tmp_dir}/out/points")
    assert T.point_values(pts).count() == len(T.FIELD_COLUMNS)


def _emitted_rows(batch):
    """Every batch re-emits state A's first window (update mode) and adds windows of its own day."""
    out = []
    for state, day in (("A", 0), ("A", batch), (f"S{batch % 3}", batch)):
        start = dt.datetime(2024, 1, 1 + day, 1)
        aqi = 40.0 + 25 * batch
        out.append((state, start, start + dt.timedelta(hours=1), aqi, aqi, aqi, batch + 1, int(start.timestamp()),
                    "Good" if aqi <= 50 else "Moderate" if aqi <= 100 else "Unhealthy"))
    return out


EMITTED = ("state string, window_start timestamp, window_end timestamp, avg_aqi double, max_aqi double, "
           "min_aqi double, record_count long, window_ts long, band string")


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_old_days_are_dropped_whole_and_counters_stay(spark, tmp_dir):
    from skiff.functions.timefmt import window_key
    from skiff.streaming.aqi_job import TUMBLING_COLUMNS

    key = window_key("window", F.col("state"), F.col("window_start"))
    full, kept = f"{tmp_dir}/full", f"{tmp_dir}/kept"
    keep = lambda df, n: keyed.keep_newest_days(spark, kept, 3)
    for root, after in ((full, None), (kept, keep)):
        write = keyed.log_writer(root, key, TUMBLING_COLUMNS, on_written=after)
        for b in range(7):
            write(spark.createDataFrame(_emitted_rows(b), EMITTED), b)
    days = sorted(x for x in os.listdir(kept) if x.startswith("day="))
    assert days == ["day=2024-01-05", "day=2024-01-06", "day=2024-01-07"]
    cols = ["key", "avg_aqi", "record_count", "band", "batch_id"]
    newest = keyed.current(spark, full).filter("window_start >= '2024-01-05'")
    assert _rows(keyed.current(spark, kept).select(cols)) == _rows(newest.select(cols))
    since = keyed.current(spark, full, since=dt.date(2024, 1, 5))
    assert _rows(since.select(cols)) == _rows(newest.select(cols))
    assert _rows(keyed.emitted_band_counts(spark, kept)) == _rows(keyed.emitted_band_counts(spark, full)) == _rows(
        keyed.band_counts(keyed.read_log(spark, full)))
    assert _rows(keyed.recent_feed(spark, kept, 2)) == _rows(keyed.recent_feed(spark, full, 2))


def test_drop_again_after_a_failure_counts_nothing_twice(spark, tmp_dir, monkeypatch):
    from skiff.functions.timefmt import window_key
    from skiff.streaming.aqi_job import TUMBLING_COLUMNS

    root = f"{tmp_dir}/log"
    write = keyed.log_writer(root, window_key("window", F.col("state"), F.col("window_start")), TUMBLING_COLUMNS)
    for b in range(4):
        write(spark.createDataFrame(_emitted_rows(b), EMITTED), b)
    want = _rows(keyed.emitted_band_counts(spark, root))
    real = keyed._days

    class Refuses:
        def delete(self, path, recursive):
            raise OSError("lost")

    monkeypatch.setattr(keyed, "_days", lambda s, r: (Refuses(), real(s, r)[1]))
    with pytest.raises(OSError):  # rolled up, not deleted
        keyed.drop_days(spark, root, dt.date(2024, 1, 3))
    monkeypatch.undo()
    assert _rows(keyed.emitted_band_counts(spark, root)) == want
    write(spark.createDataFrame(_emitted_rows(0)[:1], EMITTED), 9)  # a rolled-up day gets a later row
    after = {r.band: r["count"] for r in keyed.emitted_band_counts(spark, root).collect()}
    assert after["Good"] == dict(want)["Good"] + 1
    assert keyed.drop_days(spark, root, dt.date(2024, 1, 3)) == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    assert {r.band: r["count"] for r in keyed.emitted_band_counts(spark, root).collect()} == after
    assert keyed.drop_days(spark, root, dt.date(2024, 1, 3)) == []


def test_a_batch_writes_only_its_own_folders(spark, tmp_dir):
    from skiff.functions.timefmt import window_key
    from skiff.streaming.aqi_job import TUMBLING_COLUMNS

    root = f"{tmp_dir}/log"
    write = keyed.log_writer(root, window_key("window", F.col("state"), F.col("window_start")), TUMBLING_COLUMNS)

    def files():
        return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}

    sizes = []
    for b in range(5):
        before = files()
        write(spark.createDataFrame(_emitted_rows(b), EMITTED), b)
        now = files()
        assert all(now[f] == t for f, t in before.items())  # history untouched
        sizes.append(sum(os.path.getsize(f) for f in now.keys() - before.keys()))
    assert max(sizes[1:]) < 1.5 * min(sizes[1:])  # and the bytes of a batch do not grow with it


def test_paced_slices_become_micro_batches(spark, tmp_dir):
    from skiff.sources.files import write_slices

    values = spark.range(3_500).select(F.concat(F.lit("m"), F.col("id")).alias("value"), (F.col("id") % 3).cast("int").alias("slice"))
    files, rows = write_slices(values, f"{tmp_dir}/in")
    assert rows == [1167, 1167, 1166] and files == 1
    q = (json_file_source(spark, f"{tmp_dir}/in", files).writeStream.format("noop")
         .trigger(availableNow=True).option("checkpointLocation", f"{tmp_dir}/ckpt").start())
    q.awaitTermination()
    assert [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]] == rows


def test_progress_table_keeps_what_each_batch_measured(spark, tmp_dir):
    from skiff.streaming.progress import ProgressTable, observed, read_progress

    inp = f"{tmp_dir}/in"
    _write_batches(inp, [[_msg("A", 10.0, 1000)], [_msg("A", 20.0, 1200)], [_msg("A", 30.0, 995)], [_msg("A", 40.0, 996)]])
    table = ProgressTable(spark, f"{tmp_dir}/progress", prefix="aqi_tumbling")
    qs = _run(spark, inp, f"{tmp_dir}/run")
    table.close(qs)
    got = [(r.batch_id, r.rows_in, r.groups_dropped) for r in read_progress(spark, f"{tmp_dir}/progress").orderBy("batch_id").collect()]
    assert got == [(0, 1, 0), (1, 1, 0), (2, 1, 0), (3, 1, 1)]
    assert observed(read_progress(spark, f"{tmp_dir}/progress"), "nothing", "n").first().n == 0


def test_aqi_rejects_keep_message_and_reason(spark, tmp_dir):
    from skiff.streaming.aqi_job import start_reject_query

    inp = f"{tmp_dir}/in"
    os.makedirs(inp)
    bad = {"not json": "undecodable", "[1]": "undecodable", '{"state":"A","timestamp":1}': "missing:aqi",
           '{"aqi":"x","timestamp":1}': "bad_value:aqi", '{"aqi":1.0,"timestamp":1e30}': "bad_value:timestamp",
           '{"aqi":1.0,"timestamp":NaN}': "bad_value:timestamp", '{"aqi":1.0}': "missing:timestamp", '{"aqi":null}': "missing:aqi"}
    with open(f"{inp}/a.json", "w") as f:
        f.write("\n".join([*bad, '{"state":"A","aqi":NaN,"timestamp":5}', '{"state":"A","aqi":1e30,"timestamp":5}']) + "\n")
    q = start_reject_query(spark, lambda: json_file_source(spark, inp), f"{tmp_dir}/out", f"{tmp_dir}/ckpt", {"availableNow": True})
    await_all([q])
    got = {r.message: r.reason for r in spark.read.parquet(f"{tmp_dir}/out/rejects").collect()}
    assert got == bad


def test_await_all_stops_a_stream_that_does_not_end(spark, tmp_dir):
    inp = f"{tmp_dir}/in"
    _write_batches(inp, [[_msg("A", 10.0, 1000)]])
    cfg = AqiStreamConfig(trigger={"processingTime": "1 second"})  # never ends by itself
    qs = start_aqi_queries(spark, lambda: json_file_source(spark, inp), f"{tmp_dir}/out", f"{tmp_dir}/ckpt", cfg)
    with pytest.raises(TimeoutError):
        await_all(qs, timeout_s=5)
    assert not any(q.isActive for q in qs)


def _points(spark, batch):
    """Trip 1 is written by every batch (same series and time), another trip only once."""
    from skiff.operators import trips as T

    t0 = dt.datetime(2024, 1, 1, 8, 0)
    rows = [(1, t0, t0 + dt.timedelta(minutes=10), 1, Decimal(f"{batch + 1}.00"), Decimal("12.50"), "Cash", "CMT", batch),
            (1, t0, t0 + dt.timedelta(minutes=10), 1, Decimal(f"{batch + 1}.50"), Decimal("12.50"), "Cash", "CMT", batch + 1),
            (100 + batch, t0 + dt.timedelta(days=batch), t0 + dt.timedelta(days=batch, minutes=5), 2, Decimal("3.00"), Decimal("30.00"), "Card", "VTS", 0)]
    df = spark.createDataFrame(rows, "trip_id long, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, passenger_count int, "
                               "trip_distance decimal(18,6), fare_amount decimal(18,6), payment_type string, vendor_id string, order_in_batch long")
    zero = ["pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude", "tip_amount", "tolls_amount", "total_amount"]
    return T.to_points(T.enrich_trips(df.withColumns({c: F.lit(0).cast("decimal(10,2)") for c in zero})))


def test_last_point_write_wins_by_batch_and_position(spark, tmp_dir):
    from skiff.operators import trips as T
    from skiff.sinks.points import read_points, stored_points, stored_series, write_points

    root = f"{tmp_dir}/points"
    for b in (0, 1, 2, 2):  # the last batch is replayed
        write_points(_points(spark, b), root, b)
    assert read_points(spark, root).count() == 9
    got = {r.trip_id: r.trip_distance for r in stored_points(spark, root).collect()}
    assert got == {1: 3.5, 100: 3.0, 101: 3.0, 102: 3.0}
    assert T.point_values(stored_points(spark, root)).count() == 4 * len(T.FIELD_COLUMNS)
    assert stored_series(spark, root).distinct().count() == 4
    some = stored_points(spark, root, since=dt.date(2024, 1, 2), tag="Card")
    assert {r.trip_id for r in some.collect()} == {101, 102}
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "(tag" in plan.split("PartitionFilters")[1].split("]")[0]


def _trip(i, **more):
    return {"trip_id": i, "pickup_datetime": f"2024-01-01 0{i // 100}:{i % 100:02d}:00", "dropoff_datetime": f"2024-01-01 0{i // 100}:{i % 100:02d}:59",
            "passenger_count": 1, "trip_distance": 1.5, "fare_amount": 9.0, "payment_type": "Cash", "vendor_id": "CMT"} | more


def _run_trips(spark, tmp_dir, batches, **more):
    from skiff.streaming.trips_job import start_trip_query

    inp = f"{tmp_dir}/in"
    _write_batches(inp, batches)
    q = start_trip_query(spark, lambda: json_file_source(spark, inp, 1), f"{tmp_dir}/out", f"{tmp_dir}/ckpt",
                         trigger={"availableNow": True}, **more)
    await_all([q], 300)
    return q


def test_failing_sink_is_counted_and_loses_nothing(spark, tmp_dir):
    from skiff.sinks.points import stored_points, write_points
    from skiff.streaming.trips_job import flow_totals, read_enriched

    def store(points, root, batch_id):
        if batch_id == 1:
            raise OSError("sink down")
        write_points(points, root, batch_id)

    _run_trips(spark, tmp_dir, [[_trip(100), _trip(101)], [_trip(102), _trip(103), _trip(104, trip_distance=0)], [_trip(105)]], store=store)
    total = flow_totals(spark, f"{tmp_dir}/out").first().asDict()
    assert total == {"consumed": 6, "enriched": 5, "enrich_errors": 1, "sink_ok": 3, "sink_error": 2}
    assert {r.trip_id for r in stored_points(spark, f"{tmp_dir}/out/points").collect()} == {100, 101, 105}
    assert {r.trip_id for r in stored_points(spark, f"{tmp_dir}/out/unwritten").collect()} == {102, 103}
    assert read_enriched(spark, f"{tmp_dir}/out").count() == 5


def test_streamed_sample_counts_on_over_batches(spark, tmp_dir):
    from skiff.streaming.trips_job import read_sample

    batches = [[_trip(100 + k) for k in range(30)], [_trip(200 + k, trip_distance=1.5 if k != 19 else 0) for k in range(50)],
               [_trip(300 + k) for k in range(40)]]
    _run_trips(spark, tmp_dir, batches)
    got = sorted((r.ordinal, r.trip_id) for r in read_sample(spark, f"{tmp_dir}/out").collect())
    # position 50 is the 20th of the second batch, which is not enriched; position 100 the 20th of the third
    assert got == [(1, 100), (2, 101), (3, 102), (4, 103), (5, 104), (100, 319)]


def test_trip_rejects_tell_reasons_apart(spark, tmp_dir):
    from skiff.streaming.trips_job import read_rejects

    inp = f"{tmp_dir}/in"
    os.makedirs(inp)
    bad = {"not json": "undecodable", "[1,2]": "undecodable",
           json.dumps(_trip(100, trip_distance=1e30)): "bad_value:trip_distance", json.dumps(_trip(101, tip_amount=1e12)): "bad_value:tip_amount",
           json.dumps(_trip(102, fare_amount=float("nan"))): "bad_value:fare_amount", json.dumps(_trip(103, tolls_amount=float("inf"))): "bad_value:tolls_amount",
           json.dumps({k: v for k, v in _trip(104).items() if k != "fare_amount"}): "missing:fare_amount",
           json.dumps(_trip(105, pickup_datetime="soon")): "bad_value:pickup_datetime", json.dumps(_trip(106, trip_distance=0)): "zero_distance",
           json.dumps(_trip(107, trip_distance="far")): "bad_value:trip_distance", json.dumps(_trip(108, tip_amount="much")): "bad_value"}
    with open(f"{inp}/a.json", "w") as f:
        f.write("\n".join([*bad, json.dumps(_trip(109, trip_distance=0.004, fare_amount=0.004))]) + "\n")
    from skiff.streaming.trips_job import read_enriched, start_trip_query

    await_all([start_trip_query(spark, lambda: json_file_source(spark, inp), f"{tmp_dir}/out", f"{tmp_dir}/ckpt", {"availableNow": True})])
    assert {r.message: r.reason for r in read_rejects(spark, f"{tmp_dir}/out").collect()} == bad
    kept = read_enriched(spark, f"{tmp_dir}/out").collect()  # digits are not cut on load
    assert [(r.trip_id, float(r.trip_distance), float(r.fare_per_mile)) for r in kept] == [(109, 0.004, 1.0)]


def test_batch_whose_commit_was_lost_is_replayed_without_a_trace(spark, tmp_dir):
    """The sink has a batch, the checkpoint does not know: the restarted query takes it again."""
    from skiff.sinks.points import read_points
    from skiff.streaming.trips_job import flow_totals, read_enriched, read_sample

    batches = [[_trip(100 + k) for k in range(30)], [_trip(200 + k) for k in range(30)] + [_trip(299, trip_distance=0)]]
    _run_trips(spark, tmp_dir, batches)

    def state():
        out = f"{tmp_dir}/out"
        return [_rows(flow_totals(spark, out)), _rows(read_enriched(spark, out)), _rows(read_sample(spark, out)),
                _rows(spark.read.parquet(f"{out}/rejects")), _rows(read_points(spark, f"{out}/points"))]

    before = state()
    commits = f"{tmp_dir}/ckpt/trips/commits"
    for name in ("1", ".1.crc"):
        os.remove(f"{commits}/{name}")
    _run_trips(spark, tmp_dir, [])
    assert os.path.exists(f"{commits}/1") and state() == before


def test_live_kpis_of_odd_averages(spark):
    from skiff.operators.serve import live_kpis

    def kpis(*averages):
        rows = [(a, a, 1) for a in averages]
        return live_kpis(spark.createDataFrame(rows, "avg_aqi double, max_aqi double, record_count long")).first()

    assert kpis(1.0, 2.0, float("nan")).global_avg_aqi == 1.5
    assert kpis(1.0, float("inf")).global_avg_aqi == float("inf")
    assert kpis(1.0, float("nan")).total_records == 2


def test_processing_time_trigger_takes_files_as_they_come(spark, tmp_dir):
    inp = f"{tmp_dir}/in"
    _write_batches(inp, [[_msg("A", 10.0, 1000)]])
    cfg = AqiStreamConfig(trigger={"processingTime": "1 second"}, sliding=None)
    qs = start_aqi_queries(spark, lambda: json_file_source(spark, inp), f"{tmp_dir}/out", f"{tmp_dir}/ckpt", cfg)

    def stored(n):
        deadline = time.time() + 60
        while time.time() < deadline:
            qs[0].processAllAvailable()
            rows = keyed.current(spark, f"{tmp_dir}/out/window_log").collect()
            if sum(r.record_count for r in rows) == n:
                return rows
            time.sleep(0.5)
        raise AssertionError(f"{n} messages not stored in time")

    try:
        assert len(stored(1)) == 1
        with open(f"{inp}/later.json", "w") as f:
            f.write(json.dumps(_msg("A", 20.0, 1001)) + "\n")
        assert stored(2)[0].avg_aqi == 15.0
    finally:
        for q in qs:
            q.stop()


def test_stateful_batch_writes_one_file_a_folder(spark, tmp_dir, monkeypatch):
    """Windows of many states lie in every state partition: each used to write a file a day."""
    inp = f"{tmp_dir}/in"
    day = 86_400
    _write_batches(inp, [[_msg(f"S{k}", 10.0 + k, 1000 + day * (k % 3)) for k in range(60)]])
    _run(spark, inp, f"{tmp_dir}/run")
    log = f"{tmp_dir}/run/out/window_log"
    assert len(glob.glob(f"{log}/day=*/batch_id=*/*.parquet")) == 3
    assert keyed.read_log(spark, log).count() == 60
    # a large folder is still split
    monkeypatch.setattr(keyed, "ROWS_PER_FILE", 5)
    _run(spark, inp, f"{tmp_dir}/more")
    log = f"{tmp_dir}/more/out/window_log"
    assert len(glob.glob(f"{log}/day=*/batch_id=*/*.parquet")) > 3
    assert keyed.read_log(spark, log).count() == 60


def test_built_slices_are_packed_and_paced(spark, tmp_dir):
    from skiff.sources.files import write_built_slices

    build = lambda rows: rows.select(F.concat(F.lit("m"), F.col("id")).alias("value"))
    slices = [(spark.range(k * 3_000, k * 3_000 + n), build) for k, n in enumerate((2_500, 0, 3_000))]
    files, rows = write_built_slices(slices, f"{tmp_dir}/in")
    assert rows == [2_500, 3_000] and files == 2
    parts = glob.glob(f"{tmp_dir}/in/part-*")
    assert len(parts) == 4 and all(p.endswith(".gz") for p in parts)
    got = {r.value for r in spark.read.text(f"{tmp_dir}/in").collect()}
    assert got == {f"m{k}" for k in (*range(2_500), *range(6_000, 9_000))}
    files, rows = write_built_slices([(spark.range(0), build)], f"{tmp_dir}/none")
    assert rows == [] and spark.read.text(f"{tmp_dir}/none").count() == 0


def test_trips_and_points_are_dealt_out_once(spark, tmp_dir, monkeypatch):
    from skiff.streaming import trips_job

    dealt = []
    write = trips_job.write_partitions
    monkeypatch.setattr(trips_job, "write_partitions", lambda df, *a, **k: (dealt.append(k.get("dealt", False)), write(df, *a, **k)))
    _run_trips(spark, tmp_dir, [[_trip(100), _trip(101)]])
    assert sorted(dealt) == [False, False, True]
