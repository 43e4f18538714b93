from lakestrata import schemas as S
from lakestrata.operators.reconcile import (
    has_pending, load_missing, missing_keys, pending_count, with_target,
)
from tests.conftest import rows


def listing(spark, keys, schema=S.SOURCE_LISTING):
    return spark.createDataFrame([(f"{k}.csv" if k else None, k, "General") for k in keys], schema)


def lake(spark, keys):
    return spark.createDataFrame([(f"{k}.csv", k) for k in keys], S.LAKE_LISTING)


def test_missing_keys(spark):
    src = listing(spark, ["01-01-2021", "01-02-2021", "01-03-2021", None])
    out = missing_keys(src, lake(spark, ["01-02-2021", "01-02-2021"]), "DATE_KEY")
    assert rows(out) == [(None,), ("01-01-2021",), ("01-03-2021",)]


def test_empty_target_means_all_missing(spark):
    src = listing(spark, ["a", "b"])
    empty = spark.createDataFrame([], S.LAKE_LISTING)
    assert rows(missing_keys(src, empty, "DATE_KEY")) == [("a",), ("b",)]


def test_left_join_keeps_every_source_row(spark):
    src = listing(spark, ["a", "b"])
    out = with_target(src, lake(spark, ["a"]), "DATE_KEY", ["Cam_Lake"])
    assert rows(out, "DATE_KEY", "Cam_Lake") == [("a", "a.csv"), ("b", None)]


def test_load_missing_and_rerun_adds_nothing(spark):
    source = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "DATE_KEY string, v int")
    loaded = spark.createDataFrame([("b",)], "DATE_KEY string")
    miss = missing_keys(source.select("DATE_KEY"), loaded, "DATE_KEY")
    new = load_missing(source, miss, "DATE_KEY")
    assert rows(new) == [("a", 1), ("a", 2), ("c", 4)]
    after = loaded.unionByName(new.select("DATE_KEY"))
    again = missing_keys(source.select("DATE_KEY"), after, "DATE_KEY")
    assert again.count() == 0
    assert not has_pending(again, again)
    assert has_pending(miss)


def test_pending_count_keeps_duplicates(spark):
    a = spark.createDataFrame([("x",), ("y",)], "DATE_KEY string")
    b = spark.createDataFrame([("x",)], "DATE_KEY string")
    assert pending_count(a, b).first()["PENDING"] == 3
