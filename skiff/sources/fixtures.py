"""Input views derived from the driver's star schema (see FIXTURES.md, section B).

The reference reads a flat order-line CSV, a trip table and an air-quality CSV,
none of which ship with it. These functions derive equivalent inputs from the
driver tables with joins and column expressions only, so every query's work grows
with the tables.

Join plan for ``order_lines`` (sized for a 1000-executor cluster):
  customer ⋈ nation ⋈ region   nation/region are broadcast only after a row-count
                                proof (TPC-H fixes them at 25 / 5 rows)
  orders ⋈ customer-dim         sort-merge join on custkey (hinted: never a broadcast)
  lineitem ⋈ part               planner's choice: shuffle join at scale, AQE may
                                broadcast it at run time from its measured size
  ⋈ orders                      sort-merge join on orderkey (hinted), AQE splits skewed keys;
                                last, as its columns are the widest: they are not shuffled
                                once a line, and lines of an order come out side by side
Only the columns each query needs survive pruning down to the parquet scans.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from skiff.session import new_run_dir
from skiff.sources.tables import broadcast_if_bounded, read_table

# Largest dimension we are willing to broadcast without a shuffle.
DIMENSION_BROADCAST_MAX_ROWS = 10_000
#: Parts in which the raw order lines are built where they are only written as text.
ORDER_PARTS = 8

# ---------------------------------------------------------------------------
# Fixed values of the fixture (FIXTURES.md B): the order-line date text format,
# payment types by event type, vendor codes, and the damage rules that give the
# raw order lines something to clean (first matching rule wins per column).
#   Sales:      l_orderkey % 97 = 0 -> 'n/a'; % 89 = 0 -> ''; % 83 = 0 -> negated
#   Order.Date: l_orderkey % 101 = 0 -> 'bad'
#   Region:     l_orderkey % 103 = 0 -> NULL
# ---------------------------------------------------------------------------
ORDER_DATE_TEXT = "yyyy-MM-dd HH:mm:ss.SSS"
PAYMENT_BY_EVENT = {
    "view": "Credit Card",
    "click": "Cash",
    "signup": "No Charge",
    "error": "Dispute",
    "purchase": "",
}
VENDORS = ("CMT", "VTS", "DDS")

# ---------------------------------------------------------------------------
# Fixed values of the paced streams: spans of event time, and the damaged messages
# (# stands for the event's id, @ for its time, $ for its type; kinds in turn).
# ---------------------------------------------------------------------------
AQI_SLICES, LATE_SLICES, TRIP_SLICES = 3, 5, 3
DAMAGED_AQI = (
    "not json #",
    '{"state":"$","timestamp":@}',
    '{"state":"$","aqi":"high","timestamp":@}',
    '{"state":"$","aqi":12.5,"timestamp":1e30}',
    '{"state":"$","aqi":12.5,"timestamp":NaN}',
    '{"state":"$","aqi":12.5,"timestamp":1e12}',
    '{"state":"$","aqi":12.5}',
)
DAMAGED_TRIPS = (
    "not json #",
    '{"trip_id":#,"pickup_datetime":"@","dropoff_datetime":"@","trip_distance":1e30,"fare_amount":12.5}',
    '{"trip_id":#,"pickup_datetime":"@","dropoff_datetime":"@","trip_distance":2.5,"fare_amount":12.5,"tip_amount":1e12}',
    '{"trip_id":#,"pickup_datetime":"@","dropoff_datetime":"@","trip_distance":2.5,"fare_amount":NaN}',
    '{"trip_id":#,"pickup_datetime":"@","dropoff_datetime":"@","trip_distance":2.5}',
    '{"trip_id":#,"pickup_datetime":"soon","dropoff_datetime":"@","trip_distance":2.5,"fare_amount":12.5}',
    '{"trip_id":#,"pickup_datetime":"@","dropoff_datetime":"@","trip_distance":0,"fare_amount":12.5}',
    '{"trip_id":#,"pickup_datetime":"@',
)


def order_lines(spark: SparkSession, root: str, keys: Callable[[Column], Column] | None = None) -> DataFrame:
    """Typed order lines: one row per lineitem, money as DECIMAL(18,6). ``keys`` maps an
    order's key to whether its lines are wanted (all, if it is not given)."""
    li = read_table(
        spark, root, "lineitem",
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
    )
    orders = read_table(spark, root, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    if keys:
        li, orders = li.filter(keys(F.col("l_orderkey"))), orders.filter(keys(F.col("o_orderkey")))
    customer = read_table(spark, root, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = broadcast_if_bounded(
        read_table(spark, root, "nation", "n_nationkey", "n_regionkey"), DIMENSION_BROADCAST_MAX_ROWS
    )
    region = broadcast_if_bounded(
        read_table(spark, root, "region", "r_regionkey", "r_name"), DIMENSION_BROADCAST_MAX_ROWS
    )
    part = read_table(spark, root, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")

    cust_dim = (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select("c_custkey", "c_name", "c_mktsegment", "r_name")
    )
    # fact ⋈ fact and fact ⋈ customer are shuffle (sort-merge) joins at every
    # scale: no side may become a broadcast build side, even when small test files
    # make the static size estimate look tiny. Their hash exchanges also spread
    # single-split inputs over the cluster, so no extra repartition is needed.
    order_dim = orders.join(cust_dim.hint("merge"), orders.o_custkey == cust_dim.c_custkey)
    lines = li.join(part, li.l_partkey == part.p_partkey).join(
        order_dim.hint("merge"), li.l_orderkey == order_dim.o_orderkey
    )
    net = "cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2)))"
    return lines.select(
        F.col("l_orderkey").alias("Order_ID"),
        F.col("l_linenumber").alias("Line_No"),
        F.col("l_partkey").alias("Product_ID"),
        F.col("o_custkey").alias("Customer_ID"),
        F.col("c_name").alias("Customer_Name"),
        F.col("o_orderpriority").alias("Order_Priority"),
        F.col("p_name").alias("Product_Name"),
        F.col("o_orderdate").cast("date").alias("Order_Date"),
        F.col("l_shipdate").cast("date").alias("Ship_Date"),
        F.col("p_type").alias("Category"),
        F.col("p_brand").alias("Sub_Category"),
        F.col("r_name").alias("Region"),
        F.col("c_mktsegment").alias("Segment"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        F.col("l_discount").cast("decimal(4,2)").alias("Discount"),
        # six decimals, so that rounding shows where it happens
        F.expr(f"cast({net} * 0.01 as decimal(18,6))").alias("Sales"),
        F.expr(
            f"cast(({net} - cast(l_quantity as decimal(6,0))"
            " * cast(p_retailprice as decimal(10,2)) * 2.1) * 0.01 as decimal(18,6))"
        ).alias("Profit"),
        F.expr(
            "cast(cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(4,2)) * 0.01 as decimal(18,6))"
        ).alias("Shipping_Cost"),
    )


def _date_text(name: str) -> Column:
    """A date in ORDER_DATE_TEXT; years of four digits without the (slower) formatter."""
    day = F.col(name)
    return F.when(
        day.between(F.lit("0001-01-01").cast("date"), F.lit("9999-12-31").cast("date")),
        F.concat(day.cast("string"), F.lit(" 00:00:00.000")),
    ).otherwise(F.date_format(day.cast("timestamp_ntz"), ORDER_DATE_TEXT))


def order_lines_raw(spark: SparkSession, root: str, keys: Callable[[Column], Column] | None = None) -> DataFrame:
    """The order lines as an untyped CSV would deliver them: every column a string,
    dotted header names, and deterministic damage (see the fixed values above)."""
    ol = order_lines(spark, root, keys)
    k = F.col("Order_ID")
    sales_text = F.col("Sales").cast("string")
    return ol.select(
        k.cast("string").alias("Order.ID"),
        F.col("Line_No").cast("string").alias("Line.No"),
        F.when(k % 101 == 0, F.lit("bad"))
        .otherwise(_date_text("Order_Date"))
        .alias("Order.Date"),
        _date_text("Ship_Date").alias("Ship.Date"),
        F.col("Customer_ID").cast("string").alias("Customer.ID"),
        F.col("Customer_Name").alias("Customer.Name"),
        F.col("Order_Priority").alias("Order.Priority"),
        F.col("Product_ID").cast("string").alias("Product.ID"),
        F.col("Product_Name").alias("Product.Name"),
        F.col("Category"),
        F.col("Sub_Category").alias("Sub.Category"),
        F.col("Segment"),
        F.when(k % 103 == 0, F.lit(None).cast("string")).otherwise(F.col("Region")).alias("Region"),
        F.col("Quantity").cast("string").alias("Quantity"),
        F.col("Discount").cast("string").alias("Discount"),
        F.when(k % 97 == 0, F.lit("n/a"))
        .when(k % 89 == 0, F.lit(""))
        .when(k % 83 == 0, (-F.col("Sales")).cast("string"))
        .otherwise(sales_text)
        .alias("Sales"),
        F.col("Profit").cast("string").alias("Profit"),
        F.col("Shipping_Cost").cast("string").alias("Shipping.Cost"),
    )


def order_lines_raw_parts(spark: SparkSession, root: str) -> Iterator[DataFrame]:
    """``order_lines_raw`` in ORDER_PARTS parts by a hash of the order's key, for a writer that
    takes one after another: the joins of a part shuffle only its share of the lines. Raw lines
    that the application has stored are one part: they take no joins."""
    if (spark.sparkContext.applicationId, root.rstrip("/"), "order_lines_raw") in _STORED:
        yield stored(spark, root, "order_lines_raw")
        return
    for k in range(ORDER_PARTS):
        yield order_lines_raw(spark, root, lambda key: F.pmod(F.hash(key.cast("long")), F.lit(ORDER_PARTS)) == k)


_STORED: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, root: str, name: str, build=None) -> DataFrame:
    """A table derived from the inputs under ``root``, written once per application
    to the shared checkpoint folder and read back as plain parquet (what the
    reference reads from a file or a warehouse table).

    ``build(spark, root) -> DataFrame`` defaults to the fixture of that name.
    Writing is by executors; a rerun after executor loss rewrites the same files,
    and readers only ever see the folder after the write committed."""
    key = (spark.sparkContext.applicationId, root.rstrip("/"), name)
    path = _STORED.get(key)
    if path is None:
        path = new_run_dir(spark, name)
        (build or _BUILDERS[name])(spark, root).write.mode("overwrite").parquet(path)
        _STORED[key] = path
    return spark.read.parquet(path)


EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value")


def trips(spark: SparkSession, root: str) -> DataFrame:
    """Taxi-trip rows (FIXTURES.md B.2), one per event."""
    return _trips(read_table(spark, root, "events", *EVENT_COLUMNS))


def _trip_distance() -> Column:
    return F.expr("try_cast(user_id * 0.17 as decimal(8,2))")


def _trip_fare() -> Column:
    return F.col("value").cast("decimal(10,2)")


def _trips(e: DataFrame) -> DataFrame:
    payment = F.lit(None).cast("string")
    for event_type, pay in reversed(PAYMENT_BY_EVENT.items()):
        payment = F.when(F.col("event_type") == event_type, F.lit(pay)).otherwise(payment)
    return e.select(
        F.col("event_id").alias("trip_id"),
        F.col("ts").alias("pickup_datetime"),
        F.expr("timestampadd(SECOND, (event_id * 37) % 3600 - 600, ts)").alias("dropoff_datetime"),
        F.when(F.col("event_id") % 50 == 0, F.lit(None).cast("int"))
        .otherwise((F.col("event_id") % 7).cast("int"))
        .alias("passenger_count"),
        _trip_distance().alias("trip_distance"),
        F.expr("cast(-74.02 + (event_id % 900) * 0.0001 as decimal(10,6))").alias("pickup_longitude"),
        F.expr("cast(40.7 + (event_id % 1200) * 0.0001 as decimal(10,6))").alias("pickup_latitude"),
        F.expr("cast(-74.02 + ((event_id + 7) % 900) * 0.0001 as decimal(10,6))").alias("dropoff_longitude"),
        F.expr("cast(40.7 + ((event_id + 7) % 1200) * 0.0001 as decimal(10,6))").alias("dropoff_latitude"),
        payment.alias("payment_type"),
        _trip_fare().alias("fare_amount"),
        F.expr("cast(round(cast(value as decimal(10,2)) * 0.1, 2) as decimal(10,2))").alias("tip_amount"),
        F.lit(0).cast("decimal(10,2)").alias("tolls_amount"),
        F.expr("cast(round(cast(value as decimal(10,2)) * 1.1 + 0.5, 2) as decimal(10,2))").alias("total_amount"),
        F.when(F.col("event_id") % 101 == 0, F.lit(None).cast("string"))
        .otherwise(F.element_at(F.array(*map(F.lit, VENDORS)), (F.col("event_id") % 3 + 1).cast("int")))
        .alias("vendor_id"),
    )


def aqi_csv_rows(spark: SparkSession, root: str) -> DataFrame:
    """Air-quality rows shaped like the reference CSV (all text; lat/lng/population
    empty; no Category column, so the message derives it from the band), plus the
    event's epoch seconds as ``_epoch``."""
    return _aqi_csv_rows(read_table(spark, root, "events", *EVENT_COLUMNS))


def _aqi_value() -> Column:
    """Finer than the cents of the event's value, so that rounding shows where it happens."""
    return F.expr("cast(cast(value as decimal(10,2)) + (event_id % 1000) * 0.000001 as decimal(12,6))")


def _aqi_csv_rows(e: DataFrame) -> DataFrame:
    return e.select(
        _aqi_value().cast("string").alias("AQI"),
        F.col("event_type").alias("state_name"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("city_ascii"),
        F.date_format("ts", "yyyy-MM-dd").alias("Date"),
        F.lit("PM2.5").alias("Defining Parameter"),
        F.lit("").alias("lat"),
        F.lit("").alias("lng"),
        F.lit("").alias("population"),
        (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1_000_000.0)).alias("_epoch"),
        F.col("event_id").alias("_id"),
    )


def aqi_messages(spark: SparkSession, root: str) -> DataFrame:
    """Air-quality messages (FIXTURES.md B.3) built by the message operator from
    CSV-shaped rows; the event time is the event's own timestamp."""
    from skiff.operators.aqi import build_aqi_messages

    return build_aqi_messages(aqi_csv_rows(spark, root), timestamp=F.col("_epoch"))


# ------------------------------------------------------------------ paced message streams
def _time_slice(seconds: Column, bounds: Row, slices: int) -> Column:
    """Which of ``slices`` equal spans of the events' time a whole second lies in."""
    first, last = bounds["first"] or 0, bounds["last"] or 0
    return F.call_function("div", (seconds - F.lit(first)) * F.lit(slices), F.lit(last - first + 1))


def _bounds(spark: SparkSession, root: str) -> Row:
    """First and last whole second of the events (one row)."""
    second = F.unix_seconds(F.col("ts").cast("timestamp"))
    return read_table(spark, root, "events", "ts").agg(F.min(second).alias("first"), F.max(second).alias("last")).first()


Slices = list[tuple[DataFrame, Callable[[DataFrame], DataFrame]]]


def _aqi_values(e: DataFrame) -> DataFrame:
    """The air-quality messages of events, as text."""
    from skiff.operators.aqi import AQI_MESSAGE, build_aqi_messages

    built = build_aqi_messages(_aqi_csv_rows(e), timestamp=F.col("_epoch"))
    return built.select(F.to_json(F.struct(*[F.col(f.name) for f in AQI_MESSAGE.fields])).alias("value"))


def _aqi_slices(spark: SparkSession, root: str, slices: int, slice_of) -> Slices:
    """The events that give an air-quality message, by slice; ``slice_of`` maps (second, event id)
    to a slice. A message without a time arrives first."""
    second = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1_000_000.0)).cast("long")
    e = read_table(spark, root, "events", *EVENT_COLUMNS).filter(_aqi_value().isNotNull())
    arrives = F.coalesce(slice_of(second, F.col("event_id")).cast("int"), F.lit(0))
    return [(e.filter(arrives == k), _aqi_values) for k in range(slices)]


def _damaged(e: DataFrame, texts: tuple[str, ...], every: int, time: Column) -> DataFrame:
    """A damaged message of each event: its kind by its id, # its id, @ its time, $ its type."""
    kinds = []
    for t in texts:
        text = F.regexp_replace(F.regexp_replace(F.lit(t), "#", F.col("event_id").cast("string")), "@", time)
        kinds.append(F.regexp_replace(text, "[$]", F.col("event_type")) if "$" in t else text)
    kind = (F.floor(F.col("event_id") / every) % len(kinds) + 1).cast("int")
    return e.select(F.element_at(F.array(*kinds), kind).alias("value"))


def aqi_paced(spark: SparkSession, root: str) -> Slices:
    """The messages in AQI_SLICES spans of time, so that windows which straddle two spans are
    emitted twice, then a slice of damaged messages (every 50th event; see the fixed values):
    each slice as its events and what builds their messages (``write_built_slices``)."""
    bounds = _bounds(spark, root)
    e = read_table(spark, root, "events", "event_id", "ts", "event_type").filter(F.col("event_id") % 50 == 0)
    second = F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")
    good = _aqi_slices(spark, root, AQI_SLICES, lambda second, _: _time_slice(second, bounds, AQI_SLICES))
    return [*good, (e, lambda part: _damaged(part, DAMAGED_AQI, 50, second))]


def aqi_late(spark: SparkSession, root: str) -> Slices:
    """The messages in LATE_SLICES spans of time, but every 7th event arrives one slice late and
    every other 11th two slices late (the last slice takes what is left)."""
    bounds = _bounds(spark, root)

    def arrival(second, event):
        late = F.when(event % 7 == 0, F.lit(1)).when(event % 11 == 0, F.lit(2)).otherwise(F.lit(0))
        return F.least(_time_slice(second, bounds, LATE_SLICES) + late, F.lit(LATE_SLICES - 1))

    return _aqi_slices(spark, root, LATE_SLICES, arrival)


def trip_paced(spark: SparkSession, root: str) -> Slices:
    """The producer's trip messages in TRIP_SLICES spans of pickup time; then corrections (every
    60th trip again, with one more unit of tip and total), then damaged messages (every 40th
    event; see the fixed values): each slice as its events and what builds their messages."""
    from skiff.operators import trips as T

    bounds = _bounds(spark, root)
    more = {c: F.col(c) + F.lit(1) for c in ("tip_amount", "total_amount")}
    sent = lambda part: T.normalise_trips(_trips(part), F.lit("2024-02-01 00:00:00").cast("timestamp"))
    events = read_table(spark, root, "events", *EVENT_COLUMNS)
    valid = events.filter(T.validity_reason(_trip_distance(), _trip_fare()).isNull())
    arrives = _time_slice(F.unix_seconds(F.col("ts").cast("timestamp")), bounds, TRIP_SLICES)
    time = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return [
        *[(valid.filter(arrives == k), lambda part: T.to_trip_messages(sent(part))) for k in range(TRIP_SLICES)],
        (valid.filter(F.col("event_id") % 60 == 0), lambda part: T.to_trip_messages(sent(part).withColumns(more))),
        (events.select("event_id", "ts").filter(F.col("event_id") % 40 == 0), lambda part: _damaged(part, DAMAGED_TRIPS, 40, time)),
    ]


_BUILDERS = {"order_lines_raw": order_lines_raw, "order_lines": order_lines}
