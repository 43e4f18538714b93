"""The scan that opens only the files of missing keys, and reads each by its header."""

import os
import random

import pytest
from pyspark.sql import functions as F

from lakestrata.functions import bits as B
from lakestrata.plans.ingest import KEY, find_missing, ingest_missing, keyed_source, lake_listing
from lakestrata.sources import headers as H
from lakestrata.sources.csv import read_csv
from lakestrata.sources.listing import file_keys
from tests.conftest import rows
from tests.test_io import write_text


def files_read(df):
    """Runs a plan without exchanges; the number of files its scan opened."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    leaves = plan.collectLeaves()
    found = [leaves.apply(i).metrics().get("numFiles") for i in range(leaves.size())]
    return sum(m.get().value() for m in found if m.isDefined())


def keys_of(spark, names):
    return spark.createDataFrame([(n,) for n in names], f"{KEY} string")


def test_a_filter_holds_its_keys_and_few_others(spark):
    keys = spark.range(1000).select((F.col("id") * 2).cast("string").alias("k"))
    assert B.bits_for(0) == B.bits_for(1) == 1 << 15 and B.bits_for(1000) == 1 << 16 and B.bits_for(10**12) == B.BITS[1]
    held = B.bit_filter(keys, "k", B.bits_for(1000))
    got = spark.range(100_000).select("id", B.may_hold(held, F.col("id").cast("string")).alias("y")).where("y").collect()
    yes = {r.id for r in got}
    assert set(range(0, 2000, 2)) <= yes and len(yes) < 1000 + 100_000 / 32
    assert spark.range(1).select(B.may_hold(held, F.lit(None).cast("string")).alias("y")).first().y is None
    nothing = B.bit_filter(keys.limit(0), "k", 1 << 15)
    assert not any(nothing)


def test_only_files_of_missing_keys_are_opened(spark, workdir):
    for i in range(200):
        write_text(f"{workdir}/src/k {i:03}.csv", f"A,B\n{i},x\n")
    wanted = [f"k {i:03}" for i in range(0, 200, 10)]
    df = keyed_source(spark, f"{workdir}/src", columns=["A"], only=keys_of(spark, wanted))
    assert rows(df) == sorted((str(i), f"k {i:03}") for i in range(0, 200, 10))
    scan = H.plain_rows(spark, [f"{workdir}/src"], keep=lambda k: B.may_hold(B.bit_filter(keys_of(spark, wanted), KEY, 1 << 15), k))
    assert 20 <= files_read(scan) <= 24
    assert files_read(H.plain_rows(spark, [f"{workdir}/src"])) == 200


def test_files_that_are_loaded_may_be_unreadable(spark, workdir):
    # A file that lacks a column fails the job that opens it.
    for i in range(50):
        write_text(f"{workdir}/src/{i}.csv", f"A,B\n{i},x\n")
    lake = f"{workdir}/lake"
    ingest_missing(spark, f"{workdir}/src", lake, find_missing(file_keys(spark, f"{workdir}/src"), lake_listing(spark, lake)), columns=["A", "B"])
    for i in range(50):
        write_text(f"{workdir}/src/{i}.csv", "other\n1\n")
    write_text(f"{workdir}/src/new.csv", "b,a\ny,7\n")
    missing = find_missing(file_keys(spark, f"{workdir}/src"), lake_listing(spark, lake))
    assert rows(missing) == [("new",)]
    ingest_missing(spark, f"{workdir}/src", lake, missing, columns=["A", "B"])
    assert len(rows(read_csv(spark, lake, sep="|"))) == 51
    with pytest.raises(Exception, match="no column A in .*csv"):
        keyed_source(spark, f"{workdir}/src", columns=["A", "B"]).collect()


def test_false_hits_of_a_full_filter_are_left_out(spark, workdir, monkeypatch):
    monkeypatch.setattr(B, "BITS", (8, 8))
    monkeypatch.setattr("lakestrata.plans.ingest.bit_filter", lambda *a: b"\xff")
    for i in range(20):
        write_text(f"{workdir}/src/{i}.csv", f"A\n{i}\n")
    for most in (500_000, 0):  # broadcast or not
        monkeypatch.setattr("lakestrata.plans.ingest.BROADCAST_KEYS", most)
        assert rows(keyed_source(spark, f"{workdir}/src", columns=["A"], only=keys_of(spark, ["3", "17", None])), "A") == [("17",), ("3",)]


def test_each_file_by_its_own_header_in_one_pass(spark, workdir):
    rnd, want = random.Random(1), []
    for i in range(40):
        names = ["A", "B", "C", "D"]
        rnd.shuffle(names)
        lines = [",".join(names)]
        for k in range(rnd.randint(0, 5)):
            lines.append(",".join(f"{n}{i}-{k}" for n in names))
            want.append((f"A{i}-{k}", f"D{i}-{k}", str(i)))
        write_text(f"{workdir}/src/{i}.csv", "\n".join(lines) + "\n")
    df = keyed_source(spark, f"{workdir}/src", columns=["A", "D"])
    assert rows(df) == sorted(want)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_a_data_row_like_the_header_is_data(spark, workdir):
    write_text(f"{workdir}/src/1.csv", "A,B\nA,B\n1,2\nA,B\n")
    assert rows(keyed_source(spark, f"{workdir}/src", columns=["B"]), "B") == [("2",), ("B",), ("B",)]


def test_files_of_any_width(spark, workdir):
    for n in (3, 70, 1000):
        write_text(f"{workdir}/src/{n}.csv", ",".join(f"c{k}" for k in range(n)) + "\n" + ",".join(f"{n}-{k}" for k in range(n)) + "\n")
    lake = f"{workdir}/lake"
    missing = find_missing(file_keys(spark, f"{workdir}/src"), lake_listing(spark, lake))
    ingest_missing(spark, f"{workdir}/src", lake, missing, columns=["c0", "c999"], optional=["c999"])
    assert rows(read_csv(spark, lake, sep="|"), "c0", "c999") == [("1000-0", "1000-999"), ("3-0", None), ("70-0", None)]
    # A data row wider than the scan, behind a narrow header.
    write_text(f"{workdir}/odd/1.csv", "A\n" + ",".join("x" * 200) + "\n")
    assert H.wide_enough(lambda f: rows(keyed_source(spark, f"{workdir}/odd", columns=["A"], fields=f), "A")) == [("x",)]
    with pytest.raises(Exception, match=H.TOO_WIDE):
        keyed_source(spark, f"{workdir}/odd", columns=["A"], fields=10).collect()


def test_headers_with_marks_blanks_doubles_and_nothing_else(spark, workdir):
    write_text(f"{workdir}/src/1.csv", "﻿A , b,B,,\n1,2,3,4,5\n")
    write_text(f"{workdir}/src/2.csv", "B\n")
    write_text(f"{workdir}/src/3.csv", "")
    df = keyed_source(spark, f"{workdir}/src")
    assert df.columns == ["A", "B", KEY] and rows(df, "A", "B", KEY) == [("1", "2", "1")]


def test_no_missing_key_opens_no_file(spark, workdir):
    write_text(f"{workdir}/src/1.csv", "A\n1\n")
    df = keyed_source(spark, f"{workdir}/src", columns=["A"], only=keys_of(spark, []).limit(0))
    assert rows(df) == []
    os.makedirs(f"{workdir}/none")
    assert rows(keyed_source(spark, f"{workdir}/none", columns=["A"])) == []


def test_a_rows_share_of_the_scan_is_small(spark, tmp_path):
    # The condition on the file's key stays in the plan for each row: it tries no pattern along the address.  The scan's
    # schema has a column that isn't read, so that fields that a row lacks are NULL without an error for each.
    (tmp_path / "a.csv").write_text('A,B,C\n1\n1,"x\n""y""",3\n,,"z"\n')
    bits = B.bit_filter(spark.createDataFrame([("a",)], "k string"), "k", B.bits_for(1))
    plain = H.plain_rows(spark, [str(tmp_path)], fields=4, keep=lambda key: B.may_hold(bits, key))
    plan = plain._jdf.queryExecution().executedPlan().toString()
    assert "regexp_extract" not in plan
    relation = plain._jdf.queryExecution().analyzed().collectLeaves().head()
    assert relation.relation().schema().fieldNames()[-1] == H.UNREAD and H.UNREAD not in plan
    assert relation.relation().options().get("columnPruning").get() == "true"
    assert [tuple(r)[1:] for r in plain.collect()] == [
        ("A", "B", "C", None, None), ("1", None, None, None, None), ("1", 'x\n"y"', "3", None, None), (None, None, "z", None, None)]
