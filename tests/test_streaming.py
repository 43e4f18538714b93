import os

from pyspark.sql.types import StringType, StructField, StructType

from lakestrata.plans.ingest import lake_listing
from lakestrata.sources.csv import read_csv
from lakestrata.streaming.ingest import ingest_new_files
from tests.conftest import rows

SCHEMA = StructType([StructField("Province_State", StringType()),
                     StructField("Confirmed", StringType())])


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_stream_loads_each_file_once(spark, workdir):
    src, lake, ckpt = f"{workdir}/src", f"{workdir}/lake", f"{workdir}/ckpt"
    put(f"{src}/01-01-2021.csv", "Province_State,Confirmed\nA,1\nB,2\n")
    put(f"{src}/01-02-2021.csv", "Province_State,Confirmed\nA,3\n")
    ingest_new_files(spark, src, SCHEMA, lake, ckpt)
    listed = lake_listing(spark, lake)
    assert sorted({r["DATE_KEY"] for r in listed.collect()}) == ["01-01-2021", "01-02-2021"]

    put(f"{src}/01-03-2021.csv", "Province_State,Confirmed\nA,6\n")
    ingest_new_files(spark, src, SCHEMA, lake, ckpt)
    ingest_new_files(spark, src, SCHEMA, lake, ckpt)  # nothing new: adds nothing
    loaded = read_csv(spark, lake, sep="|")
    assert rows(loaded, "DATE_KEY", "Province_State", "Confirmed") == [
        ("01-01-2021", "A", "1"), ("01-01-2021", "B", "2"), ("01-02-2021", "A", "3"),
        ("01-03-2021", "A", "6")]


def test_batch_ingest_plan(spark, workdir):
    from lakestrata.plans.ingest import find_missing, ingest_missing, source_listing
    src, lake = f"{workdir}/src", f"{workdir}/lake"
    put(f"{src}/01-01-2021.csv", "Province_State,Confirmed\nA,1\n")
    put(f"{src}/01-02-2021.csv", "Province_State,Confirmed\nA,3\n")
    html = "".join(f'<a title="{k}.csv">{k}.csv</a>' for k in ["01-01-2021", "01-02-2021"])
    page = spark.createDataFrame([(html,)], "html string")
    offered = source_listing(page, "General")
    missing = find_missing(offered, lake_listing(spark, lake))
    assert rows(missing, "DATE_KEY") == [("01-01-2021",), ("01-02-2021",)]
    ingest_missing(spark, src, lake, missing)
    assert find_missing(offered, lake_listing(spark, lake)).count() == 0
    loaded = read_csv(spark, lake, sep="|")
    assert rows(loaded, "DATE_KEY", "Confirmed") == [("01-01-2021", "1"), ("01-02-2021", "3")]


def test_batch_ingest_reads_each_layout_by_name(spark, workdir):
    from lakestrata.plans.ingest import find_missing, ingest_missing, source_listing
    old, new, lake = f"{workdir}/old", f"{workdir}/new", f"{workdir}/lake"
    put(f"{old}/01-01-2021.csv", "Province_State,Confirmed\nA,1\n")
    put(f"{new}/01-02-2021.csv", "Confirmed,Province_State,Deaths\n3,A,0\n")
    html = "".join(f'<a title="{k}.csv">{k}.csv</a>' for k in ["01-01-2021", "01-02-2021"])
    offered = source_listing(spark.createDataFrame([(html,)], "html string"), "General")
    ingest_missing(spark, [old, new], lake, find_missing(offered, lake_listing(spark, lake)))
    loaded = read_csv(spark, lake, sep="|")
    assert rows(loaded, "DATE_KEY", "Province_State", "Confirmed", "Deaths") == [
        ("01-01-2021", "A", "1", None), ("01-02-2021", "A", "3", "0")]


def test_batch_ingest_opens_only_the_files_of_a_glob(spark, workdir):
    from lakestrata.plans.ingest import keyed_source
    src = f"{workdir}/src"
    for i in range(5):
        put(f"{src}/01-0{i + 1}-2021.csv", f"Province_State,Confirmed\nA,{i}\n")
    df = keyed_source(spark, src, glob="01-0[24]-2021.csv")
    assert rows(df, "DATE_KEY", "Confirmed") == [("01-02-2021", "1"), ("01-04-2021", "3")]
    assert keyed_source(spark, src, columns=["Confirmed"], modified_after="2100-01-01T00:00:00").count() == 0


def test_mixed_headers_in_one_folder(spark, workdir):
    from lakestrata.plans.ingest import keyed_source
    src = f"{workdir}/src"
    put(f"{src}/1.csv", "\ufeffA,B\n1,2\n")
    put(f"{src}/2.csv", "b,C,A\n4,5,3\n")
    put(f"{src}/3.csv", "A,B\n")
    df = keyed_source(spark, src, columns=["A", "B", "C"], optional=["C"])
    assert rows(df, "A", "B", "C", "DATE_KEY") == [("1", "2", None, "1"), ("3", "4", "5", "2")]


def test_stream_and_batch_share_one_zone(spark, workdir):
    from lakestrata.plans.ingest import find_missing, ingest_missing
    from lakestrata.sources.listing import file_keys
    src, lake, ckpt = f"{workdir}/src", f"{workdir}/lake", f"{workdir}/ckpt"
    put(f"{src}/1.csv", "Province_State,Confirmed\nA,1\n")
    put(f"{src}/2.CSV", "Province_State,Confirmed\nA,2\n")
    ingest_new_files(spark, src, SCHEMA, lake, ckpt)
    put(f"{src}/3.csv", "Province_State,Confirmed\nA,3\n")
    missing = find_missing(file_keys(spark, src), lake_listing(spark, lake))
    assert rows(missing) == [("3",)]
    ingest_missing(spark, src, lake, missing)
    ingest_new_files(spark, src, SCHEMA, lake, ckpt)  # reads 3 again and replaces its folder
    assert rows(read_csv(spark, lake, sep="|").selectExpr("cast(DATE_KEY as string) k", "Confirmed")) == [
        ("1", "1"), ("2", "2"), ("3", "3")]


def test_stream_stops_on_a_reordered_header(spark, workdir):
    import pytest
    src, lake, ckpt = f"{workdir}/src", f"{workdir}/lake", f"{workdir}/ckpt"
    put(f"{src}/01-01-2021.csv", "Confirmed,Province_State\n1,A\n")
    with pytest.raises(Exception):
        ingest_new_files(spark, src, SCHEMA, lake, ckpt)


def test_upper_case_extension_is_listed_and_loaded(spark, workdir):
    from lakestrata.plans.lake import LakePaths, load, reconcile, offered_by_folder
    src = f"{workdir}/src"
    head = "Province_State,Country_Region,Last_Update,Confirmed,Deaths,Recovered\n"
    put(f"{src}/01-01-2021.csv", head + "A,C,2021-01-01,1,0,0\n")
    put(f"{src}/01-02-2021.CSV", head + "A,C,2021-01-02,3,0,0\n")
    paths = LakePaths(f"{workdir}/lake")
    offered = offered_by_folder(spark, src)
    assert sorted(r["DATE_KEY"] for r in offered.collect()) == ["01-01-2021", "01-02-2021"]
    assert reconcile(spark, paths, {"us": offered}) == {"us": 2}
    assert load(spark, paths, {"us": src}) is True
    loaded = read_csv(spark, paths.raw("us"), sep="|")
    assert rows(loaded, "DATE_KEY", "Confirmed") == [("01-01-2021", "1"), ("01-02-2021", "3")]
