import datetime as dt
import glob
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from conftest import SF_SMALL
from skiff.operators import clean, marts
from skiff.plans.registry import QUERIES
from skiff.sinks import tables
from skiff.sources import fixtures, kafka
from skiff.sources.files import SHUFFLE_CLEANUP, read_raw_csv, write_raw_csv
from skiff.sources.jdbc import day_ranges, read_jdbc_ordered, read_jdbc_table


def test_raw_csv_round_trip_gives_same_marts(spark, tmp_dir):
    raw = fixtures.order_lines_raw(spark, SF_SMALL)
    raw.write.option("header", "true").csv(f"{tmp_dir}/csv")
    back = read_raw_csv(spark, f"{tmp_dir}/csv")
    assert back.columns == raw.columns and all(t == "string" for _, t in back.dtypes)
    a = sorted(tuple(r) for r in marts.category_sales(clean.load_clean(back)).collect())
    b = sorted(tuple(r) for r in marts.category_sales(clean.load_clean(raw)).collect())
    assert a == b


def _write_orders(spark, root):
    """Order tables with keys that repeat, are NULL or have no match, and dates of odd years."""
    day = dt.datetime(1996, 1, 2)
    keys = [*range(40), *range(40), None, 7, 999]
    tables = {
        "lineitem": (
            [(k, i % 5 if i % 11 else None, i, 3.0, 100.25, 0.05, 0.02, day) for i, k in enumerate(keys)],
            "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp",
        ),
        "orders": (
            [(k, k % 3, day if k % 4 else dt.datetime(1, 1, 1), "1-URGENT") for k in [*range(40), 7]] + [(None, 1, day, ""), (41, None, day, None)],
            "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string",
        ),
        "customer": ([(k, f"c,{k}" if k else None, 0, "BUILDING") for k in (0, 1, 2, 2)], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
        "nation": ([(0, 0)], "n_nationkey int, n_regionkey int"),
        "region": ([(0, "ASIA")], "r_regionkey int, r_name string"),
        "part": ([(k, f'a "p" {k}', "B", "T", 10.0) for k in (0, 1, 2, 3, 3)], "p_partkey long, p_name string, p_brand string, p_type string, p_retailprice double"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")


def test_parts_of_the_raw_lines_are_the_raw_lines(spark, tmp_dir):
    _write_orders(spark, tmp_dir)
    text = lambda df: sorted(map(str, df.collect()))
    parts = [text(p) for p in fixtures.order_lines_raw_parts(spark, tmp_dir)]
    whole = text(fixtures.order_lines_raw(spark, tmp_dir))
    assert whole and sorted(sum(parts, [])) == whole
    assert len(parts) > 1 and max(map(len, parts)) < len(whole) / 2
    stored = fixtures.stored(spark, tmp_dir, "order_lines_raw")  # from now on one part, without joins
    (part,) = fixtures.order_lines_raw_parts(spark, tmp_dir)
    assert "Join" not in part._jdf.queryExecution().optimizedPlan().toString() and text(part) == text(stored)


def test_csv_query_keeps_packed_text_only(spark, tmp_dir):
    from skiff.plans import retail

    _write_orders(spark, tmp_dir)
    rows = sorted(map(str, QUERIES["csv_clean_orders"](spark, tmp_dir).collect()))
    assert not [name for _, root, name in fixtures._STORED if root == tmp_dir]
    folder = retail._CSV[spark.sparkContext.applicationId, tmp_dir].removeprefix("file:")
    assert glob.glob(f"{folder}/*.csv.gz") and not glob.glob(f"{folder}/*.csv")
    assert rows and rows == sorted(map(str, retail.edge(retail.derived_clean_lines(spark, tmp_dir)).collect()))


def test_shuffle_files_go_with_the_part_that_made_them(spark, tmp_dir):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {name for name in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in name}
    part = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).cast("string").alias("n")).select(F.col("k").cast("string"), "n")
    before = shuffled()
    write_raw_csv((part.select("k", "n") for _ in range(2)), f"{tmp_dir}/csv")
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
    assert sorted(tuple(r) for r in read_raw_csv(spark, f"{tmp_dir}/csv").collect()) == sorted((str(k), str(143 if k < 6 else 142)) for k in range(7) for _ in range(2))


def test_date_text_equals_the_formatter(spark):
    days = spark.sql("select explode(array(date'0001-01-01', date'1582-10-10', date'1996-02-29', date'9999-12-31', date_add(date'9999-12-31', 1), date_add(date'0001-01-01', -1), null)) d")
    want = F.date_format(F.col("d").cast("timestamp_ntz"), fixtures.ORDER_DATE_TEXT)
    assert [r[0] for r in days.select(fixtures._date_text("d")).collect()] == [r[0] for r in days.select(want).collect()]


def test_column_types_ddl_keeps_counts_numeric():
    schema = StructType([StructField("n", LongType())])
    assert tables.column_types_ddl(schema) == "n BIGINT"


def test_publish_marts_to_catalog(spark):
    tables.setup_namespace(spark, "skiff_test")
    tables.setup_namespace(spark, "skiff_test")  # idempotent
    bundle = marts.build_marts(clean.load_clean(fixtures.order_lines_raw(spark, SF_SMALL)))
    names = tables.publish_marts(bundle, "skiff_test")
    assert len(names) == 4
    assert spark.table("skiff_test.CATEGORY_SALES").count() == bundle["CATEGORY_SALES"].count()
    spark.catalog.setCurrentDatabase("default")


def test_jdbc_write_and_partitioned_read(spark):
    url = "jdbc:derby:memory:skiffdb;create=true"
    df = spark.range(1, 1001).select(F.col("id").alias("trip_id"), (F.col("id") * 2).alias("v"))
    tables.write_jdbc(df, url, "trips", properties={"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    back = read_jdbc_table(
        spark, url, "trips", partition_column="trip_id", lower_bound=1, upper_bound=1000,
        num_partitions=4, properties={"driver": "org.apache.derby.jdbc.EmbeddedDriver"},
    )
    assert back.rdd.getNumPartitions() == 4
    assert back.count() == 1000 and back.agg(F.sum("v")).first()[0] == 1001000
    own = read_jdbc_table(spark, url, "trips", partition_column="trip_id", num_partitions=4,
                          properties={"driver": "org.apache.derby.jdbc.EmbeddedDriver"})  # the source's own bounds
    sizes = own.groupBy(F.spark_partition_id()).count().collect()
    assert own.count() == 1000 and all(240 < r["count"] < 260 for r in sizes)


def test_day_ranges_are_about_equal():
    d = [dt.date(2024, 1, k) for k in range(1, 11)]
    assert day_ranges([], 4) == []
    assert day_ranges([(d[0], 5)], 4) == [(d[0], None)]
    even = day_ranges([(x, 10) for x in d], 5)
    assert [a for a, _ in even] == d[::2] and [b for _, b in even] == [*d[2::2], None]
    hot = day_ranges([(x, 1_000 if x == d[3] else 10) for x in d], 4)  # one day holds nearly all
    assert hot[0][0] == d[0] and hot[-1][1] is None and len(hot) <= 4
    for a, b in zip(hot, hot[1:]):
        assert a[1] == b[0]


def test_jdbc_ordered_read_keeps_time_order_without_a_shuffle(spark):
    url, driver = "jdbc:derby:memory:skifford;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    start = dt.datetime(2024, 1, 1)
    rows = [(k, start + dt.timedelta(hours=(k * 37) % 240, minutes=k % 3)) for k in range(500)] + [(1000, None), (1001, None)]
    df = spark.createDataFrame(rows, "trip_id long, pickup_datetime timestamp")
    tables.write_jdbc(df, url, "ordered_trips", properties=driver)
    back = read_jdbc_ordered(spark, url, "ordered_trips", "pickup_datetime", ["trip_id"], parts=4, properties=driver)
    assert back.rdd.getNumPartitions() == 5  # four ranges and the rows without a time
    got = [(r.trip_id, r.pickup_datetime) for r in back.collect()]
    assert got == sorted(rows, key=lambda r: (r[1] is not None, r[1] or start, r[0]))
    assert "Exchange" not in back._jdf.queryExecution().executedPlan().toString()
    none = read_jdbc_ordered(spark, url, "(SELECT * FROM ordered_trips WHERE \"trip_id\" < 0) t", "pickup_datetime", parts=4, properties=driver)
    assert none.count() == 0


def test_swapped_marts_are_never_missing(spark):
    tables.setup_namespace(spark, "skiff_swap", select=False)
    numbers = lambda n: spark.range(n).select(F.col("id").alias("k"))
    view = tables.swap_mart(numbers(3), "M", "skiff_swap")
    planned = spark.table(view)  # a reader of the first version
    for n in (4, 5):
        tables.swap_mart(numbers(n), "M", "skiff_swap")
        assert spark.sql("SELECT COUNT(*) FROM skiff_swap.M").first()[0] == n
        if n == 4:
            assert planned.count() == 3
    versions = [t.name for t in spark.catalog.listTables("skiff_swap") if "__v" in t.name]
    assert len(versions) == 2
    with pytest.raises(Exception):  # a load that fails leaves the published version
        tables.swap_mart(numbers(3).select(F.raise_error(F.lit("bad")).alias("k")), "M", "skiff_swap")
    assert spark.table("skiff_swap.M").count() == 5
    assert spark.catalog.currentDatabase() == "default"


def test_kafka_options():
    src = kafka.kafka_source_options("b:9092", "aqi-stream")
    assert src == {"kafka.bootstrap.servers": "b:9092", "subscribe": "aqi-stream",
                   "startingOffsets": "latest", "failOnDataLoss": "false"}
    early = kafka.kafka_source_options("b:9092", "t", starting="earliest", max_offsets_per_trigger=10)
    assert early["startingOffsets"] == "earliest" and early["maxOffsetsPerTrigger"] == "10"
    sink = kafka.kafka_sink_options("b:9092", "t", retries=5, retry_backoff_ms=1000)
    assert sink["kafka.acks"] == "all" and sink["kafka.retries"] == "5" and sink["kafka.retry.backoff.ms"] == "1000"


def test_json_value_round_trip(spark):
    from skiff.operators import aqi as A

    msgs = fixtures.aqi_messages(spark, SF_SMALL)
    back = A.parse_aqi(A.to_json_value(msgs)).drop("event_time")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, msgs.collect()))
