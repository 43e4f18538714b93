import datetime as dt
import random

from pyspark.sql import functions as F

from lakestrata.operators.series import cumulative_to_daily, lag_value, previous_values
from tests.conftest import rows

SCHEMA = "STATE string, COUNTRY string, DATE_ID date, FONTE string, CONFIRMED int"


def d(day):
    return dt.date(2021, 1, 1) + dt.timedelta(days=day)


def daily(spark, data, **kw):
    df = spark.createDataFrame(data, SCHEMA)
    out = cumulative_to_daily(df, ["STATE", "COUNTRY"], ["DATE_ID"], ["CONFIRMED"],
                              tiebreak=["FONTE"], **kw)
    return rows(out, "STATE", "COUNTRY", "DATE_ID", "FONTE", "CONFIRMED_AC", "CONFIRMED")


def test_gap_returns_full_value(spark):
    data = [("S", "C", d(0), "G", 10), ("S", "C", d(1), "G", 15),
            ("S", "C", d(2), "G", None), ("S", "C", d(3), "G", 20)]
    for kw in ({"split_above": 0}, {"split_above": None}, {}):
        got = [r[-1] for r in daily(spark, data, **kw)]
        assert got == [10, 5, None, 20]
        got = [r[-1] for r in daily(spark, data, ignore_null_gaps=True, **kw)]
        assert got == [10, 5, None, 5]


def test_drop_stays_negative_and_null_state_is_own_series(spark):
    data = [("S", "C", d(0), "G", 5), ("S", "C", d(1), "G", 4),
            (None, "C", d(0), "G", 7), (None, "C", d(1), "G", 9),
            ("S", None, d(0), "G", 1), ("S", None, d(5), "G", 3)]
    got = daily(spark, data)
    assert (None, "C", d(1), "G", 9, 2) in got
    assert ("S", "C", d(1), "G", 4, -1) in got
    assert ("S", None, d(5), "G", 3, 2) in got
    assert (None, "C", d(0), "G", 7, 7) in got


def test_same_day_both_sources_ordered_by_tiebreak(spark):
    data = [("S", "C", d(0), "US", 10), ("S", "C", d(0), "GENERAL", 8),
            ("S", "C", d(1), "GENERAL", 12)]
    first = daily(spark, data)
    assert first == [("S", "C", d(0), "GENERAL", 8, 8), ("S", "C", d(0), "US", 10, 2),
                     ("S", "C", d(1), "GENERAL", 12, 2)]
    for _ in range(2):
        assert daily(spark, list(reversed(data))) == first


def test_null_date_first(spark):
    data = [("S", "C", None, "G", 3), ("S", "C", d(0), "G", 10)]
    assert [r[-1] for r in daily(spark, data)] == [3, 7]


def test_sum_of_daily_is_last_cumulative(spark):
    rnd = random.Random(3)
    data = []
    for loc in range(5):
        total = 0
        for day in range(40):
            total += rnd.randint(-2, 9)
            data.append((f"S{loc}", "C", d(day), "G", total))
    df = spark.createDataFrame(data, SCHEMA)
    out = cumulative_to_daily(df, ["STATE", "COUNTRY"], ["DATE_ID"], ["CONFIRMED"],
                              tiebreak=["FONTE"])
    sums = out.groupBy("STATE").agg(F.sum("CONFIRMED").alias("s"),
                                    F.max_by("CONFIRMED_AC", "DATE_ID").alias("last"))
    assert all(r["s"] == r["last"] for r in sums.collect())


def _random_series(spark, seed, n=1500):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        hot = rnd.random() < 0.4
        state = "HOT" if hot else rnd.choice(["A", "B", None, "C"])
        country = "X" if hot else rnd.choice(["X", "Y", None])
        day = None if rnd.random() < 0.02 else d(rnd.randint(0, 60))
        val = None if rnd.random() < 0.1 else rnd.randint(-50, 500)
        data.append((state, country, day, f"F{i:05d}", val))
    return spark.createDataFrame(data, SCHEMA)


def test_two_level_lag_equals_one_window(spark):
    for seed in (1, 2):
        df = _random_series(spark, seed)
        for ignore in (False, True):
            b = previous_values(df, ["STATE", "COUNTRY"], ["DATE_ID", "FONTE"], ["CONFIRMED"],
                                split_above=None, ignore_nulls=ignore)
            for split_above in (0, 100):  # every key split / only the hot one
                a = previous_values(df, ["STATE", "COUNTRY"], ["DATE_ID", "FONTE"],
                                    ["CONFIRMED"], ignore_nulls=ignore, split_above=split_above)
                assert rows(a) == rows(b)


def test_hot_keys_are_a_table(spark):
    from lakestrata.operators.series import hot_keys
    df = _random_series(spark, 1)
    assert rows(hot_keys(df, ["STATE", "COUNTRY"], split_above=300)) == [("HOT", "X")]
    assert hot_keys(df, ["STATE", "COUNTRY"], split_above=1).count() == df.select("STATE", "COUNTRY").distinct().count()
    plan = previous_values(df, ["STATE", "COUNTRY"], ["DATE_ID"], ["CONFIRMED"],
                           split_above=10_000)._jdf.queryExecution().optimizedPlan().toString()
    assert "__series_part" not in plan


def test_no_list_of_keys_in_the_plan(spark):
    df = _random_series(spark, 1)
    plan = previous_values(df, ["STATE", "COUNTRY"], ["DATE_ID", "FONTE"], ["CONFIRMED"],
                           split_above=20)._jdf.queryExecution().optimizedPlan().toString()
    assert "HOT" not in plan and " IN (" not in plan and "Window" in plan


def test_lag_value_split(spark):
    df = _random_series(spark, 5, 600)
    a = lag_value(df, ["STATE"], ["DATE_ID", "FONTE"], "CONFIRMED", "P", split_above=0)
    b = lag_value(df, ["STATE"], ["DATE_ID", "FONTE"], "CONFIRMED", "P", split_above=None)
    assert rows(a) == rows(b)
    assert a.columns == df.columns + ["P"]


def test_timestamp_order_equals_one_window(spark):
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    data = [(rnd.choice([1, 1, 1, 2, 3]), base + dt.timedelta(minutes=rnd.randint(0, 60 * 72)), i,
             None if rnd.random() < 0.1 else rnd.random()) for i in range(2000)]
    df = spark.createDataFrame(data, "user_id long, ts timestamp, event_id long, value double")
    for ignore in (False, True):
        b = previous_values(df, ["user_id"], ["ts", "event_id"], ["value"], split_above=None,
                            ignore_nulls=ignore)
        for split_above in (0, 500):
            a = previous_values(df, ["user_id"], ["ts", "event_id"], ["value"],
                                ignore_nulls=ignore, split_above=split_above)
            assert rows(a) == rows(b)


def parts_of(split):
    """Rows per part of the split keys, from the written table."""
    files = [f for f in split.inputFiles() if "series-parts" in f]
    return [r["count"] for r in split.sparkSession.read.parquet(*files).groupBy("__series_part").count().collect()]


def test_hot_day_is_cut_into_ranges(spark):
    rnd = random.Random(5)
    day = dt.date(2024, 3, 1)
    data = [("K", day if rnd.random() < 0.9 else day + dt.timedelta(days=1), i,
             None if rnd.random() < 0.1 else rnd.randint(0, 99)) for i in range(3000)]
    data += [("Q", day, i, i) for i in range(3000, 3050)]
    df = spark.createDataFrame(data, "k string, d date, t long, v int")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for ignore in (False, True):
            plain = previous_values(df, ["k"], ["d", "t"], ["v"], split_above=None, ignore_nulls=ignore)
            split = previous_values(df, ["k"], ["d", "t"], ["v"], split_above=500, ignore_nulls=ignore)
            assert max(parts_of(split)) < 1500
            assert rows(split) == rows(plain)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_text_order_with_a_common_prefix_is_cut(spark):
    rnd = random.Random(9)
    data = [("K", f"one-long-common-prefix-{rnd.randint(0, 10**9):010d}-{i}", rnd.randint(0, 99)) for i in range(2000)]
    df = spark.createDataFrame(data, "k string, s string, v int")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        split = previous_values(df, ["k"], ["s"], ["v"], split_above=300)
        assert max(parts_of(split)) < 1000
        assert rows(split) == rows(previous_values(df, ["k"], ["s"], ["v"], split_above=None))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
