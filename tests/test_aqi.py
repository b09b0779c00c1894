import datetime as dt

import pytest
from pyspark.sql import functions as F

from skiff.operators import aqi as A


def _msgs(spark, rows):
    return spark.createDataFrame(rows, "value string")


def test_build_messages_defaults_and_skips(spark):
    rows = spark.createDataFrame(
        [
            (" 42 ", " Ohio ", "Akron", "2022-01-01", "Good", "PM2.5", "", None, "12"),
            ("x", "Ohio", "Akron", "2022-01-01", "Good", "PM2.5", "1", "2", "3"),  # AQI unparseable
            ("60", "Ohio", "Akron", "2022-01-01", "Moderate", "PM2.5", "abc", "2", "3"),  # bad lat
        ],
        "AQI string, state_name string, city_ascii string, Date string, Category string, "
        "`Defining Parameter` string, lat string, lng string, population string",
    )
    out = A.build_aqi_messages(rows, timestamp=F.lit(1.5)).collect()
    assert len(out) == 1
    m = out[0]
    assert (m.state, m.aqi, m.category, m.band, m.lat, m.lng, m.population, m.timestamp) == (
        "Ohio", 42.0, "Good", "Good", 0.0, 0.0, 12.0, 1.5)


def test_message_counts(spark):
    rows = spark.createDataFrame([("1", "2"), ("x", "2"), ("3", "bad"), ("4", "")], "AQI string, lat string")
    c = A.message_counts(rows).first()
    assert (c.rows_read, c.sent, c.skipped) == (4, 2, 2)


def test_build_messages_absent_columns(spark):
    rows = spark.createDataFrame([("250",)], "AQI string")
    m = A.build_aqi_messages(rows, timestamp=F.lit(0.0)).first()
    assert (m.state, m.city, m.date, m.parameter, m.category, m.band) == (
        "Unknown", "Unknown", "", "Unknown", "Very Unhealthy", "Very Unhealthy")


def test_parse_tolerates_bad_json(spark):
    raw = _msgs(
        spark,
        [
            ('{"state":"A","aqi":10.0,"timestamp":1000.9}',),
            ('{"state":"A","aqi":"high","timestamp":1000}',),  # wrong type → NULL aqi → dropped
            ("not json",),
            ('{"state":"B","aqi":NaN,"timestamp":1001}',),  # bare NaN token is accepted
            ('{"state":"C","timestamp":1002}',),  # missing aqi
            (None,),
        ],
    )
    out = A.parse_aqi(raw).orderBy("state").collect()
    assert [r.state for r in out] == ["A", "B"]
    assert out[0].event_time == dt.datetime(1970, 1, 1, 0, 16, 40)  # truncated to the second
    assert out[1].aqi != out[1].aqi  # NaN


def test_tumbling_defaults_exact_average(spark):
    rows = [
        ('{"state":"A","aqi":10.01,"timestamp":0}',),
        ('{"state":"A","aqi":10.02,"timestamp":29}',),
        ('{"state":"A","aqi":50.0,"timestamp":30}',),
        ('{"state":"B","aqi":300.01,"timestamp":5}',),
    ]
    out = {(r.state, r.window_ts): r for r in A.tumbling(A.parse_aqi(_msgs(spark, rows))).collect()}
    a0 = out[("A", 0)]
    assert (a0.avg_aqi, a0.max_aqi, a0.min_aqi, a0.record_count, a0.band) == (10.02, 10.02, 10.01, 2, "Good")
    assert out[("A", 30)].record_count == 1
    assert out[("B", 0)].band == "Hazardous"


def test_sliding_assigns_each_row_to_four_windows(spark):
    rows = [('{"state":"A","aqi":1.0,"timestamp":100}',)]
    out = A.sliding(A.parse_aqi(_msgs(spark, rows))).collect()
    assert sorted(r.window_ts for r in out) == [45, 60, 75, 90]
    assert all(r.record_count == 1 for r in out)


def test_nan_average_is_nan_and_hazardous(spark):
    rows = [('{"state":"A","aqi":NaN,"timestamp":1}',), ('{"state":"A","aqi":5.0,"timestamp":2}',)]
    r = A.tumbling(A.parse_aqi(_msgs(spark, rows))).first()
    assert r.avg_aqi != r.avg_aqi and r.band == "Hazardous" and r.record_count == 2


def test_averages_of_fine_large_and_odd_values(spark):
    def mean(*values):
        rows = [(f'{{"state":"A","aqi":{v},"timestamp":1}}',) for v in values]
        r = A.tumbling(A.parse_aqi(_msgs(spark, rows))).first()
        assert r.record_count == len(values)
        return r.avg_aqi

    assert mean("0.004", "0.007") == 0.01  # 0.0055: nothing is cut before the mean
    assert mean("10.0049", "10.0051") == 10.01  # exactly 10.005: half up
    assert mean("1e30", "2e30") == pytest.approx(1.5e30)
    assert mean("1e308", "5.0") == 5e307
    assert mean('"Infinity"', "5.0") == float("inf")
    assert mean('"Infinity"', '"-Infinity"') != mean('"Infinity"', '"-Infinity"')


def test_sliding_panes_equal_rows_dealt_to_windows(spark):
    rows = [(f'{{"state":"{"AB"[k % 2]}","aqi":{k * 1.37 % 90},"timestamp":{k * 7.3}}}',) for k in range(300)]
    events = A.parse_aqi(_msgs(spark, rows))
    for duration, slide in (("60 seconds", "15 seconds"), ("50 seconds", "20 seconds"), ("10 seconds", "10 seconds")):
        by = (F.window("event_time", duration, slide).alias("win"), "state")
        dealt = A._finish(events.groupBy(*by).agg(*A._partial_aggs("aqi", False)), "state", False)
        got = A.sliding(events, duration, slide)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, dealt.collect()))
    with pytest.raises(ValueError):
        A.sliding(events, "10 seconds", "25 seconds")
    plan = A.sliding(events)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("partial_sum"):]
    assert "Expand" not in below and "Generate" not in below  # rows are dealt to windows after they are added up
