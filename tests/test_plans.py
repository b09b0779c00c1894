"""Plan-shape guards for the properties that matter at scale: pruned and pushed-down
scans, partial aggregation before every exchange, no unpartitioned window over data."""

import re

from conftest import SF_SMALL
from skiff.plans.registry import QUERIES


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _read_schema(phys: str) -> list[str]:
    m = re.search(r"ReadSchema: struct<([^>]*)>", phys)
    assert m, phys
    # field names precede ':'; decimal(18,2) commas are not separators
    return sorted(re.findall(r"(?:^|,)([^:,()]+):", m.group(1)))


def test_cleaning_scan_is_pruned_and_filtered(spark):
    df = QUERIES["sales_band_counts"](spark, SF_SMALL)
    phys = _plan(df)
    # only the five columns cleaning needs are read, and the NOT NULL checks reach the scan
    assert _read_schema(phys) == sorted(["Order.Date", "Category", "Region", "Sales", "Profit"])
    assert "PushedFilters: [IsNotNull(Sales)" in phys
    assert "Join" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_mart_reads_only_its_columns_of_the_cleaned_lines(spark):
    df = QUERIES["category_sales"](spark, SF_SMALL)
    assert _read_schema(_plan(df)) == sorted(["Category", "Sales", "Profit", "Profit_Margin"])
    assert "Join" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_fact_joins_are_never_broadcast(spark):
    from skiff.sources import fixtures

    plan = _plan(fixtures.order_lines(spark, SF_SMALL))
    # lineitem ⋈ orders and orders ⋈ customer stay shuffle joins even on tiny files
    assert plan.count("SortMergeJoin") == 2, plan


def test_aggregations_are_partial_before_exchange(spark):
    for name in ("category_sales", "aqi_sliding_batch", "latest_per_state"):
        phys = _plan(QUERIES[name](spark, SF_SMALL))
        assert re.search(r"partial_(sum|count|max_by)", phys), name


def test_quality_report_is_one_scan_with_partial_aggregation(spark):
    from skiff.operators import quality
    from skiff.sources.fixtures import stored

    rows, kept = quality.report_rows(stored(spark, SF_SMALL, "order_lines_raw"))
    phys = _plan(quality.report_groups(rows, kept))
    assert phys.count("FileScan") == 1 and "partial_count" in phys


def test_no_single_partition_window_over_rows(spark):
    for name in ("subcategory_rank", "cumulative_revenue", "yoy_growth", "latest_per_state"):
        phys = _plan(QUERIES[name](spark, SF_SMALL))
        assert "SinglePartition" not in phys, name


# Windows over one partition are allowed only where the input is bounded by
# construction: the per-partition offsets of a global ordinal (one row per
# partition) and the six-band distribution.
BOUNDED_SINGLE_PARTITION_WINDOWS = {"trip_sample", "band_distribution"}


def test_no_cartesian_no_python_no_unbounded_single_partition_window(spark):
    for name, q in QUERIES.items():
        plan = _plan(q(spark, SF_SMALL))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
            assert bad not in plan, (name, bad)
        if name not in BOUNDED_SINGLE_PARTITION_WINDOWS:
            assert not _single_partition_windows(plan), name


def _single_partition_windows(plan: str) -> list[str]:
    """Window operators fed by ``Exchange SinglePartition`` (through a Sort): the
    physical form of a window without PARTITION BY."""
    lines = plan.split("\n")
    found = []
    for i, line in enumerate(lines):
        if re.search(r"\bWindow \[", line):
            for below in lines[i + 1:i + 4]:
                op = re.sub(r"^[\s:+\-*()0-9]*", "", below)
                if op.startswith("Sort "):
                    continue
                if op.startswith("Exchange SinglePartition"):
                    found.append(line.strip()[:120])
                break
    return found


def test_single_partition_window_detector(spark):
    # the detector itself: the two bounded cases must be found, a keyed window not
    assert _single_partition_windows(_plan(QUERIES["band_distribution"](spark, SF_SMALL)))
    assert _single_partition_windows(_plan(QUERIES["trip_sample"](spark, SF_SMALL)))
    assert not _single_partition_windows(_plan(QUERIES["subcategory_rank"](spark, SF_SMALL)))


def test_readers_of_a_few_columns_write_no_raw_lines(spark):
    from skiff.plans import retail
    from skiff.sources import fixtures

    root = SF_SMALL + "/."  # a path of its own: nothing is stored for it yet
    kept = lambda: {name for _, at, name in fixtures._STORED if at == root}
    optimized = QUERIES["profit_margin"](spark, root)._jdf.queryExecution().optimizedPlan().toString()
    assert not kept() and "c_name" not in optimized.split("Relation")[0] and "p_brand" not in optimized.split("Relation")[0]
    assert retail.cleaned(spark, root).columns == list(retail.ANALYSED)
    assert kept() == {"order_lines_clean"}
