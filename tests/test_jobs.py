import os

from conftest import SF_SMALL
from skiff import jobs
from skiff.operators import clean, marts
from skiff.sources import fixtures


def test_retail_jobs_from_csv(spark, tmp_dir):
    raw = fixtures.order_lines_raw(spark, SF_SMALL)
    raw.write.option("header", "true").csv(f"{tmp_dir}/csv")
    args = jobs.parser().parse_args(["retail-marts", "--input", f"{tmp_dir}/csv", "--output", f"{tmp_dir}/marts"])
    jobs.JOBS[args.job](spark, args)
    got = spark.read.parquet(f"{tmp_dir}/marts/CATEGORY_SALES")
    want = marts.category_sales(clean.load_clean(raw))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    args = jobs.parser().parse_args(["retail-report", "--input", f"{tmp_dir}/csv", "--output", f"{tmp_dir}/rep"])
    jobs.JOBS[args.job](spark, args)
    assert sorted(os.listdir(f"{tmp_dir}/rep")) == [
        "cleaning_summary", "describe", "null_counts", "row_count", "schema", "value_counts"]


def test_trip_publish_then_consume(spark, tmp_dir):
    fixtures.trips(spark, SF_SMALL).write.parquet(f"{tmp_dir}/trips")
    a = jobs.parser().parse_args(["trip-publish", "--input", f"{tmp_dir}/trips", "--output", f"{tmp_dir}/msgs"])
    jobs.JOBS[a.job](spark, a)
    from skiff.streaming.aqi_job import await_all
    from skiff.streaming.trips_job import read_enriched, start_trip_query
    from skiff.sources.files import json_file_source

    q = start_trip_query(spark, lambda: json_file_source(spark, f"{tmp_dir}/msgs"), f"{tmp_dir}/out",
                         f"{tmp_dir}/ckpt", trigger={"availableNow": True})
    await_all([q])
    n_valid = fixtures.trips(spark, SF_SMALL).filter("trip_distance > 0 AND fare_amount > 0").count()
    assert read_enriched(spark, f"{tmp_dir}/out").count() == n_valid
    assert spark.read.parquet(f"{tmp_dir}/msgs_rejected").count() + n_valid == 1000
