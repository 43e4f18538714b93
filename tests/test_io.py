import datetime as dt
import glob
import os

from pyspark.sql.types import DateType, StringType, StructField, StructType

from lakestrata import schemas as S
from lakestrata.plans.ingest import lake_listing, read_missing, write_missing
from lakestrata.sources.csv import (
    read_csv, read_csv_layouts, read_csv_strings, read_or_empty, read_partitioned_csv,
)
from lakestrata.sources.listing import file_keys, list_files, page_links
from lakestrata.sources.sinks import write_csv, write_single_csv
from tests.conftest import rows


def write_text(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_layouts_are_unioned_by_name(spark, workdir):
    write_text(f"{workdir}/a/1.csv", "A,B,C\n1,2,3\n")
    write_text(f"{workdir}/b/2.csv", "A,C,B\n4,6,5\n")
    out = read_csv_layouts(spark, [f"{workdir}/a", f"{workdir}/b"])
    assert rows(out, "A", "B", "C") == [("1", "2", "3"), ("4", "5", "6")]
    write_text(f"{workdir}/c/3.csv", "A,B\n7,8\n")
    out = read_csv_layouts(spark, [f"{workdir}/a", f"{workdir}/c"])
    assert rows(out, "A", "B", "C") == [("1", "2", "3"), ("7", "8", None)]


def test_read_strings_and_missing_input(spark, workdir):
    write_text(f"{workdir}/r/x.csv", "Lat,Confirmed\n45.5,123.0\n")
    df = read_csv_strings(spark, f"{workdir}/r")
    assert [f.dataType for f in df.schema.fields] == [StringType(), StringType()]
    schema = StructType([StructField("k", StringType())])
    empty = read_or_empty(spark, lambda: read_csv(spark, f"{workdir}/nope", schema), schema)
    assert empty.count() == 0 and empty.schema == schema


def test_partitioned_write_null_date_and_pruned_read(spark, workdir):
    schema = StructType([StructField("K", StringType()), StructField("DATE_ID", DateType())])
    df = spark.createDataFrame([("a", dt.date(2021, 1, 1)), ("b", None), ("c", dt.date(2021, 1, 2))],
                               schema)
    write_csv(df, f"{workdir}/t", partition_by=["DATE_ID"])
    folders = sorted(os.path.basename(p) for p in glob.glob(f"{workdir}/t/DATE_ID=*"))
    assert folders == ["DATE_ID=2021-01-01", "DATE_ID=2021-01-02",
                       "DATE_ID=__HIVE_DEFAULT_PARTITION__"]
    back = read_partitioned_csv(spark, f"{workdir}/t", schema)
    assert rows(back) == rows(df)
    nulls = back.filter("DATE_ID IS NULL")
    assert rows(nulls) == [("b", None)]
    plan = nulls._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnull(DATE_ID" in plan


def test_single_file_list_round_trip(spark, workdir):
    df = spark.createDataFrame([(k,) for k in ["01-01-2021", "01-02-2021"]], S.MISSING_LIST)
    path = f"{workdir}/missing"
    assert write_missing(df.repartition(4), path) == 2
    assert len(glob.glob(f"{path}/part-*.csv")) == 1
    assert rows(read_missing(spark, path)) == rows(df)
    assert read_missing(spark, f"{workdir}/never").count() == 0
    many = f"{workdir}/many"
    write_single_csv(df.repartition(2), many)
    assert len(glob.glob(f"{many}/part-*.csv")) == 1
    assert rows(read_missing(spark, many)) == rows(df)


def test_file_keys_from_names_and_folders(spark, workdir):
    write_text(f"{workdir}/lake/01-22-2020.csv", "x\n1\n")
    write_text(f"{workdir}/lake/xcsv-01.csv", "x\n1\n")
    write_text(f"{workdir}/lake/notes.txt", "x\n")
    got = rows(file_keys(spark, f"{workdir}/lake"))
    assert got == [("01-22-2020.csv", "01-22-2020"), ("xcsv-01.csv", "xcsv-01")]
    write_text(f"{workdir}/part/DATE_KEY=01-22-2020/part-0.csv", "x\n1\n")
    got = rows(file_keys(spark, f"{workdir}/part", partition_column="DATE_KEY"))
    assert got == [("part-0.csv", "01-22-2020")]
    assert lake_listing(spark, f"{workdir}/absent").count() == 0
    assert list_files(spark, f"{workdir}/lake", glob="*.csv").columns == ["path", "length"]


def test_page_links_title_pattern(spark):
    html = ('<a title="01-22-2020.csv" href="/x/01-22-2020.csv">01-22-2020.csv</a>'
            '<a title="README.md" href="/r">README.md</a>'
            '<a title="01-23-2020.CSV" href="/y">01-23-2020.CSV</a>')
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    got = rows(page_links(pages, tipo="US"), "Cam_Git", "DATE_KEY", "Tipo")
    assert got == [("01-22-2020.csv", "01-22-2020", "US")]


def test_dynamic_overwrite_replaces_only_given_partitions(spark, workdir):
    from lakestrata.sources.sinks import write_table
    schema = "K string, D string"
    first = spark.createDataFrame([("a", "1"), ("b", "2")], schema)
    write_table(first, f"{workdir}/t", partition_by=["D"])
    update = spark.createDataFrame([("c", "2")], schema)
    write_table(update, f"{workdir}/t", partition_by=["D"], dynamic_overwrite=True)
    assert rows(spark.read.parquet(f"{workdir}/t"), "K", "D") == [("a", 1), ("c", 2)]
    write_table(update, f"{workdir}/t", partition_by=["D"])
    assert rows(spark.read.parquet(f"{workdir}/t"), "K", "D") == [("c", 2)]


def test_tune_for_scale_sets_runtime_conf(spark):
    from lakestrata.session import SCALE_CONF, tune_for_scale
    before = {k: spark.conf.get(k, None) for k in SCALE_CONF}
    try:
        tune_for_scale(spark, {"spark.sql.shuffle.partitions": "123"})
        assert spark.conf.get("spark.sql.shuffle.partitions") == "123"
        assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_read_some_partition_folders_keeps_the_column(spark, workdir):
    schema = StructType([StructField("K", StringType()), StructField("DATE_ID", DateType())])
    df = spark.createDataFrame([("a", dt.date(2021, 1, 1)), ("b", dt.date(2021, 1, 2)),
                                ("c", dt.date(2021, 1, 3))], schema)
    write_csv(df, f"{workdir}/t", partition_by=["DATE_ID"])
    some = read_partitioned_csv(spark, f"{workdir}/t", schema,
                                paths=[f"{workdir}/t/DATE_ID=2021-01-02",
                                       f"{workdir}/t/DATE_ID=2021-01-03"])
    assert rows(some) == [("b", dt.date(2021, 1, 2)), ("c", dt.date(2021, 1, 3))]


def test_mixed_headers_in_one_folder_fail_loudly(spark, workdir):
    import pytest
    write_text(f"{workdir}/mixed/1.csv", "A,B\n1,2\n")
    write_text(f"{workdir}/mixed/2.csv", "B,A\n4,3\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        read_csv_strings(spark, f"{workdir}/mixed").collect()
    loose = read_csv_strings(spark, f"{workdir}/mixed", check_headers=False)
    assert loose.count() == 2
    write_text(f"{workdir}/same/1.csv", "A,B\n1,2\n")
    write_text(f"{workdir}/same/2.csv", "A,B\n3,4\n")
    assert rows(read_csv_strings(spark, f"{workdir}/same")) == [("1", "2"), ("3", "4")]


def test_any_text_comes_back(spark, workdir):
    texts = ["", " ", "  a  ", 'a "b" c', '"', '\\', '\\"', "a|b,c", "line\nline", "cr\rlf\r\n", "\t", None, "NULL", "\u00e9"]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    for sep in ("|", ","):
        write_csv(df.repartition(3), f"{workdir}/t{ord(sep)}", sep=sep)
        assert rows(read_csv(spark, f"{workdir}/t{ord(sep)}", df.schema, sep=sep)) == rows(df)


def test_timestamps_keep_their_fraction(spark, workdir):
    df = spark.sql("select timestamp'2024-01-02 03:04:05.678901' t, timestamp_ntz'2024-01-02 03:04:05.5' n, timestamp'2024-01-01' w")
    write_csv(df, f"{workdir}/t")
    assert rows(read_csv(spark, f"{workdir}/t", df.schema, sep="|")) == rows(df)


def test_files_hold_a_bounded_number_of_rows(spark, workdir):
    write_csv(spark.range(100).coalesce(1), f"{workdir}/t", rows_per_file=30)
    assert len(glob.glob(f"{workdir}/t/part-*.csv")) == 4


def test_odd_file_names_are_loaded_once(spark, workdir):
    from lakestrata.plans.ingest import find_missing, ingest_missing
    names = ["01 01 2021.csv", "01=01.csv", "50%.csv", "a+b.CSV", "x%20y.csv", "q&#;~.csv"]
    for i, n in enumerate(names):
        write_text(f"{workdir}/src/{n}", f"A,B\n{i},x\n")
    lake = f"{workdir}/lake"
    for _ in range(3):
        missing = find_missing(file_keys(spark, f"{workdir}/src"), lake_listing(spark, lake))
        ingest_missing(spark, f"{workdir}/src", lake, missing)
        assert find_missing(file_keys(spark, f"{workdir}/src"), lake_listing(spark, lake)).count() == 0
        back = read_csv(spark, lake, sep="|")
        assert rows(back, "A", "DATE_KEY") == sorted((str(i), n[:-4]) for i, n in enumerate(names))


def test_quoted_and_multi_line_fields_are_loaded_as_they_are(spark, workdir):
    from lakestrata.plans.ingest import find_missing, ingest_missing
    write_text(f"{workdir}/src/1.csv", 'A,B\n"S ""x""","two\nlines"\n" b ",""\n')
    lake = f"{workdir}/lake"
    ingest_missing(spark, f"{workdir}/src", lake, find_missing(file_keys(spark, f"{workdir}/src"), lake_listing(spark, lake)))
    back = read_csv(spark, lake, StructType([StructField(c, StringType()) for c in ("A", "B", "DATE_KEY")]), sep="|")
    assert rows(back, "A", "B") == [(" b ", ""), ('S "x"', "two\nlines")]


def test_title_attribute_in_any_form(spark):
    html = ("<a title='1.csv'><a TITLE=2.csv href=x><a title = \"3 b.csv\"><a data-title=\"4.csv\"><a title=\"5.csvx\">"
            "<a title=\"it's.csv\">")
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert [r[0] for r in rows(page_links(pages), "DATE_KEY")] == ["1", "2", "3 b", "it's"]


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    import pytest
    from lakestrata import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)
    with pytest.raises(ValueError, match="checkpoint.dir"):
        session.checkpoint_root(Session())
