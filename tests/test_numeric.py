"""Exact half-up rounding of quotients (``rounded_quotient``) against Python's
Decimal, including quotients that sit just below a tie with huge denominators —
the case where dividing DECIMALs and then rounding would round twice."""

from decimal import ROUND_HALF_UP, Decimal, localcontext

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skiff.functions.numeric import exact_mean, rounded_quotient, sql_rounded_quotient

CENTS = st.integers(min_value=-(10**20), max_value=10**20).map(lambda c: Decimal(c) / 100)


def _want(n, d):
    if d == 0:
        return None
    with localcontext() as ctx:
        ctx.prec = 100
        return (n / d).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(CENTS, CENTS), min_size=1, max_size=200))
def test_rounded_quotient_is_exact(spark, pairs):
    df = spark.createDataFrame(pairs, "n decimal(38,2), d decimal(38,2)")
    out = df.select(
        "n", "d", rounded_quotient("n", "d", 2).alias("q"), F.expr(sql_rounded_quotient("n", "d", 2)).alias("s")
    ).collect()
    for r in out:
        assert r.q == r.s == _want(r.n, r.d), r


def test_near_ties_with_huge_denominators(spark):
    rows = []
    for den in (Decimal("123456789012345.67"), Decimal("99999999999999.99")):
        for tie in (Decimal("1.005"), Decimal("-2.675"), Decimal("33.335")):
            exact = tie * den
            for delta in (Decimal("-0.01"), Decimal("0"), Decimal("0.01")):
                rows.append((exact.quantize(Decimal("0.01")) + delta, den))
    df = spark.createDataFrame(rows, "n decimal(38,2), d decimal(38,2)")
    for r in df.select("n", "d", rounded_quotient("n", "d", 2).alias("q")).collect():
        assert r.q == _want(r.n, r.d), r


def test_exact_mean_of_a_large_group(spark):
    # 3 rows summing to 1.005 * 3 - 0.0001: the mean sits just below the tie
    df = spark.createDataFrame([(Decimal("1.0050"),), (Decimal("1.0050"),), (Decimal("1.0049"),)], "x decimal(10,4)")
    assert df.agg(exact_mean("x", 2).alias("m")).first().m == Decimal("1.00")


def test_row_percent_fast_path_equals_exact_below_its_bound(spark):
    from skiff.functions.numeric import percent_of, row_percent_of

    rows = [(Decimal(p) / 100, Decimal(s) / 100)
            for p, s in ((1, 3), (-2675, 1000), (12345, 99), (199999999999, 19999999999999), (5, 0))]
    df = spark.createDataFrame(rows, "p decimal(18,2), s decimal(18,2)")
    out = df.select(row_percent_of("p", "s").alias("a"), percent_of("p", "s").alias("b")).collect()
    assert all(r.a == r.b for r in out), out


def test_integer_inputs_stay_exact(spark):
    df = spark.createDataFrame([(10**17 + 5, 10), (-7, 2), (2, 3)], "n long, d long")
    out = df.select(rounded_quotient("n", "d", 2).alias("q"), F.expr(sql_rounded_quotient("n", "d", 2)).alias("s"))
    want = [Decimal("10000000000000000.50"), Decimal("-3.50"), Decimal("0.67")]
    assert [r.q for r in out.collect()] == [r.s for r in out.collect()] == want
