"""Hot keys: one order key holds a third of all order lines and one customer a third
of all orders. The fact joins of the order-line build must split those partitions
(AQE skew join) instead of sending each hot key to one task, and keep every row.
Thresholds are lowered so that the split triggers at test size."""

import datetime as dt

from pyspark.sql import functions as F

from skiff.sources import fixtures

SKEW_AT_TEST_SIZE = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}
N_LINES, N_ORDERS, N_CUSTOMERS = 30000, 5000, 500


def _write_star(spark, root):
    day = F.lit(dt.datetime(1996, 1, 2))
    hot = lambda modulo: F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % modulo)
    tables = {
        "lineitem": spark.range(N_LINES).select(
            hot(N_ORDERS).cast("long").alias("l_orderkey"),
            (F.col("id") % 200).alias("l_partkey"),
            (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"),
            F.lit(2.0).alias("l_quantity"),
            F.lit(100.0).alias("l_extendedprice"),
            F.lit(0.05).alias("l_discount"),
            F.lit(0.02).alias("l_tax"),
            day.alias("l_shipdate"),
        ),
        "orders": spark.range(N_ORDERS).select(
            F.col("id").alias("o_orderkey"),
            hot(N_CUSTOMERS).cast("long").alias("o_custkey"),
            day.alias("o_orderdate"),
            F.lit("1-URGENT").alias("o_orderpriority"),
        ),
        "customer": spark.range(N_CUSTOMERS).select(
            F.col("id").alias("c_custkey"),
            F.concat(F.lit("c"), F.col("id")).alias("c_name"),
            (F.col("id") % 25).cast("int").alias("c_nationkey"),
            F.lit("BUILDING").alias("c_mktsegment"),
        ),
        "nation": spark.range(25).select(
            F.col("id").cast("int").alias("n_nationkey"), (F.col("id") % 5).cast("int").alias("n_regionkey")
        ),
        "region": spark.range(5).select(
            F.col("id").cast("int").alias("r_regionkey"), F.concat(F.lit("R"), F.col("id")).alias("r_name")
        ),
        "part": spark.range(200).select(
            F.col("id").alias("p_partkey"),
            F.concat(F.lit("p"), F.col("id")).alias("p_name"),
            F.lit("Brand#1").alias("p_brand"),
            F.lit("T").alias("p_type"),
            F.lit(10.0).alias("p_retailprice"),
        ),
    }
    for name, df in tables.items():
        df.write.parquet(f"{root}/{name}.parquet")


def test_hot_keys_are_split_in_fact_joins(spark, tmp_dir):
    _write_star(spark, tmp_dir)
    saved = {k: spark.conf.get(k, None) for k in SKEW_AT_TEST_SIZE}
    try:
        for k, v in SKEW_AT_TEST_SIZE.items():
            spark.conf.set(k, v)
        qe = fixtures.order_lines(spark, tmp_dir)._jdf.queryExecution()
        assert qe.toRdd().count() == N_LINES  # every row kept
        plan = qe.executedPlan().toString()
        # lineitem ⋈ orders (hot order key) and orders ⋈ customer (hot customer)
        assert plan.count("SortMergeJoin(skew=true)") == 2, plan
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
