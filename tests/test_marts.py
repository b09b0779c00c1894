import pytest

from conftest import SF_SMALL
from skiff.operators import marts, serve
from skiff.plans import retail


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_build_marts_equals_single_marts(spark):
    clean = retail.clean_lines(spark, SF_SMALL)
    bundle = marts.build_marts(clean)
    assert _rows(bundle["CATEGORY_SALES"]) == _rows(marts.category_sales(clean))
    assert _rows(bundle["YEARLY_REVENUE"]) == _rows(marts.yearly_revenue(clean))
    assert _rows(bundle["REGION_PERFORMANCE"]) == _rows(marts.region_performance(clean))
    assert _rows(bundle["SUBCATEGORY_RANK"]) == _rows(marts.subcategory_rank(clean))


def test_sql_and_dataframe_paths_agree(spark):
    clean = retail.clean_lines(spark, SF_SMALL)
    assert _rows(marts.yearly_revenue_sql(spark, clean)) == _rows(marts.yearly_revenue(clean))
    losses = marts.subcategory_profit_sql(spark, clean, losses_only=True).collect()
    assert losses and all(r.Total_Profit < 0 for r in losses)


def test_mart_filters(spark):
    bundle = marts.build_marts(retail.clean_lines(spark, SF_SMALL))
    with pytest.raises(ValueError):
        serve.kpi_yearly(bundle["YEARLY_REVENUE"], years=[])
    none = serve.kpi_yearly(bundle["YEARLY_REVENUE"], years=[1900]).first()
    assert (none.TOTAL_REV, none.TOTAL_ORD, none.AVG_MARGIN) == (0, 0, 0)
    cat = bundle["CATEGORY_SALES"].orderBy("Category").first().Category
    top = serve.top_subcategories(bundle["SUBCATEGORY_RANK"], category=cat, n=3).collect()
    assert len(top) == 3 and {r.CATEGORY for r in top} == {cat}
    one = serve.kpi_category(bundle["CATEGORY_SALES"], category=cat).first()
    row = bundle["CATEGORY_SALES"].filter(f"Category = '{cat}'").first()
    assert one.CAT_SALES == row.TOTAL_SALES


def test_dense_rank_ties(spark):
    df = spark.createDataFrame(
        [("A", "x", 10), ("A", "y", 10), ("A", "z", 5), ("B", "w", 1)],
        "Category string, Sub_Category string, TOTAL_SALES int",
    )
    ranked = {(r.Category, r.Sub_Category): r.SALES_RANK for r in marts._with_sales_rank(df).collect()}
    assert ranked == {("A", "x"): 1, ("A", "y"): 1, ("A", "z"): 2, ("B", "w"): 1}


def test_cleaned_lines_and_marts_are_built_once_per_application(spark):
    a, b = retail.cleaned(spark, SF_SMALL), retail.cleaned(spark, SF_SMALL + "/")
    assert a.inputFiles() == b.inputFiles()  # same written table, not a rebuild
    m1, m2 = retail.published_marts(spark, SF_SMALL), retail.published_marts(spark, SF_SMALL)
    assert m1["CATEGORY_SALES"].inputFiles() == m2["CATEGORY_SALES"].inputFiles()
    # the written table is the cleaned lines, row for row
    assert a.count() == retail.clean_lines(spark, SF_SMALL).count()
