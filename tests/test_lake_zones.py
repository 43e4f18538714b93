import datetime as dt
import glob
import os
from decimal import Decimal

from pyspark.sql import functions as F

from lakestrata import schemas as S
from lakestrata.operators.quality import COVID_RULES, report
from lakestrata.plans.refined import null_date_rows, publish_refined, read_trusted, refine
from lakestrata.plans.trusted import harmonise_reports, quality_table, raw_to_trusted, run_trusted
from lakestrata.sources.csv import read_csv_strings
from tests.conftest import rows

GENERAL_HEADER = ("FIPS,Admin2,Province_State,Country_Region,Last_Update,Lat,Long_,Confirmed,"
                  "Deaths,Recovered,Active,Combined_Key,Incident_Rate,Case_Fatality_Ratio")
US_HEADER = ("Province_State,Country_Region,Last_Update,Lat,Long_,Confirmed,Deaths,Recovered,"
             "Active,FIPS,Incident_Rate,Total_Test_Results,Mortality_Rate")

GENERAL_DAY1 = [
    ',,S1,C1,2021-01-01 05:22:33,45.5,10.1,10,1,0,9,"S1, C1",12.5,10.0',
    '1001,CountyX,S1,C1,2021-01-01 05:22:33,45.5,10.1,999,9,0,990,"x",1,1',
    ',,,C2,2021-01-01 04:00:00,-20,30,5,0,0,5,C2,-2.5,0',
    ',,S3,C3,2021-01-01 04:00:00,90.7,200,123.0,0,0,0,"S3, C3",1,0',
    ',,S4,C4,1/22/2020 17:00,abc,,0,0,0,0,"S4, C4",99999999999,0',
]
GENERAL_DAY2 = [
    ',,S1,C1,2021-01-02 05:22:33,45.5,10.1,15,1,0,14,"S1, C1",13,6.67',
    ',,,C2,2021-01-02 04:00:00,-20,30,4,0,0,4,C2,0,0',
    ',,S5,,2021-01-02 04:00:00,1,1,2,0,0,2,S5,0,0',
]
US_DAY1 = ["Texas,US,2021-01-01 04:30:00,31,-100,100,2,,98,48,5,1000,2.0"]
US_DAY2 = ["Texas,US,2021-01-02 04:30:00,31,-100,130,3,,127,48,6,1100,2.3",
           "S1,C1,2021-01-02 06:00:00,45.5,10.1,14,1,0,13,,13,1,7.14"]


def write_raw(root):
    def put(path, header, lines):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write(header + "\n" + "\n".join(lines) + "\n")
    put(f"{root}/general/01-01-2021.csv", GENERAL_HEADER, GENERAL_DAY1)
    put(f"{root}/general/01-02-2021.csv", GENERAL_HEADER, GENERAL_DAY2)
    put(f"{root}/us/01-01-2021.csv", US_HEADER, US_DAY1)
    put(f"{root}/us/01-02-2021.csv", US_HEADER, US_DAY2)


def raw(spark, root):
    return (read_csv_strings(spark, f"{root}/general"), read_csv_strings(spark, f"{root}/us"))


def test_harmonised_types_and_casts(spark, workdir):
    write_raw(workdir)
    h = harmonise_reports(*raw(spark, workdir))
    assert h.columns == S.HARMONISED_COLUMNS
    assert h.count() == 10  # county row dropped
    got = {(r["STATE"], r["COUNTRY"], r["DATE_ID"]): r for r in h.collect()}
    s1 = got[("S1", "C1", dt.date(2021, 1, 1))]
    assert s1["INCIDENT_RATE"] == Decimal("13") and s1["CASE_FATALITY_RATIO"] == Decimal("10")
    assert got[(None, "C2", dt.date(2021, 1, 1))]["INCIDENT_RATE"] == Decimal("-3")
    assert got[("S3", "C3", dt.date(2021, 1, 1))]["CONFIRMED"] == 123
    s4 = got[("S4", "C4", None)]
    assert s4["INCIDENT_RATE"] is None
    assert got[("Texas", "US", dt.date(2021, 1, 1))]["FONTE"] == "US"
    assert got[("Texas", "US", dt.date(2021, 1, 1))]["CASE_FATALITY_RATIO"] == Decimal("2")
    with_fmt = harmonise_reports(*raw(spark, workdir), date_formats=["M/d/yyyy H:mm"])
    assert with_fmt.filter(F.col("STATE") == "S4").first()["DATE_ID"] == dt.date(2020, 1, 22)


def test_quality_labels_on_raw_edges(spark, workdir):
    write_raw(workdir)
    q = quality_table(harmonise_reports(*raw(spark, workdir)))
    by_state = {r["STATE"]: r for r in q.filter(F.col("DATE_ID") == dt.date(2021, 1, 1)).collect()}
    assert by_state["S3"]["teste_range_lat"] == "latitude_fora_range"
    assert by_state["S3"]["teste_range_long"] == "long_fora_range"
    s4 = q.filter(F.col("STATE") == "S4").first()
    assert s4["teste_range_lat"] == "latitude_fora_range"
    assert s4["teste_completude_long"] == "sem_longitude"
    assert s4["teste_incident_rate"] == "incident_rate_nulos"
    assert s4["NEW_CASE_FATALITY_RATIO"] is None
    assert by_state["S1"]["NEW_CASE_FATALITY_RATIO"] == 10.0
    assert by_state["S1"]["check_calc_case_fatality_ratio"] is True
    rep = report(q, COVID_RULES).groupBy("RULE").agg(F.sum("N").alias("n"))
    assert {r["n"] for r in rep.collect()} == {q.count()}


def test_trusted_daily_values(spark, workdir):
    write_raw(workdir)
    t = raw_to_trusted(*raw(spark, workdir))
    assert t.columns == S.TRUSTED_COLUMNS
    assert [f.dataType.simpleString() for f in t.schema.fields] == \
        [f.dataType.simpleString() for f in S.TRUSTED.fields]
    got = {(r["FONTE"], r["STATE"], r["COUNTRY"], r["DATE_ID"]): (r["CONFIRMED_AC"], r["CONFIRMED"])
           for r in t.collect()}
    assert got[("GENERAL", "S1", "C1", dt.date(2021, 1, 2))] == (15, 5)
    assert got[("US", "S1", "C1", dt.date(2021, 1, 2))] == (14, -1)
    assert got[("GENERAL", None, "C2", dt.date(2021, 1, 2))] == (4, -1)
    assert got[("US", "Texas", "US", dt.date(2021, 1, 2))] == (130, 30)
    assert got[("GENERAL", "S4", "C4", None)] == (0, 0)
    assert t.filter(F.col("STATE") == "S1").first()["CASE_FATALITY_RATIO"] == 10.0


def test_refined_star_and_invariants(spark, workdir):
    write_raw(workdir)
    paths = run_trusted(spark, f"{workdir}/general", f"{workdir}/us", f"{workdir}/trusted",
                        raw_sep=",")
    assert os.path.isdir(f"{workdir}/trusted/DATE_ID=__HIVE_DEFAULT_PARTITION__")
    labelled = spark.read.parquet(paths["quality"])
    assert labelled.count() == 10
    assert {r.name for r in COVID_RULES} <= set(labelled.columns)
    from lakestrata.plans.trusted import quality_summary
    summary = {(r["RULE"], r["LABEL"]): r["N"] for r in quality_summary(spark, paths["quality"]).collect()}
    assert summary[("teste_range_lat", "latitude_fora_range")] == 2
    assert summary[("teste_completude_long", "sem_longitude")] == 1
    trusted = read_trusted(spark, f"{workdir}/trusted")
    assert trusted.count() == 10
    tables = refine(trusted)
    fact, loc, cal = tables["fato_covid"], tables["dim_location"], tables["dim_calendar"]
    assert fact.columns == S.FACT_COLUMNS + [S.FACT_PARTITION]
    assert loc.columns == S.DIM_LOCATION_COLUMNS
    assert loc.count() == loc.select("LOCATION_KEY").distinct().count()
    assert fact.join(loc, fact.LOCATION_KEY.eqNullSafe(loc.LOCATION_KEY), "left_anti").count() == 0
    keys = {r[0] for r in loc.select("LOCATION_KEY").collect()}
    assert keys == {"S1C1", "C2", "S3C3", "S4C4", None, "TexasUS"}
    assert cal.count() == 3  # two days and the NULL date
    assert rows(null_date_rows(spark, trusted), "STATE") == [("S4",)]
    publish_refined(tables, f"{workdir}/refined")
    assert len(glob.glob(f"{workdir}/refined/fato_covid/DATE_KEY_PART=*")) == 3
    again = spark.read.parquet(f"{workdir}/refined/dim_location")
    assert rows(again) == rows(loc)
    # per series without NULLs, the daily values add up to the last cumulative value
    s1 = trusted.filter((F.col("STATE") == "Texas")).agg(F.sum("CONFIRMED")).first()[0]
    assert s1 == 130


def test_csv_zones_round_trip(spark, workdir):
    write_raw(workdir)
    run_trusted(spark, f"{workdir}/general", f"{workdir}/us", f"{workdir}/trusted_csv",
                raw_sep=",", fmt="csv")
    assert glob.glob(f"{workdir}/trusted_csv/DATE_ID=2021-01-01/*.csv")
    back = read_trusted(spark, f"{workdir}/trusted_csv", fmt="csv")
    assert [f.dataType for f in back.schema.fields] == [f.dataType for f in S.TRUSTED.fields]
    direct = raw_to_trusted(*raw(spark, workdir))
    assert rows(back) == rows(direct)
    tables = refine(back)
    publish_refined(tables, f"{workdir}/refined_csv", fmt="csv")
    cal = spark.read.option("header", True).option("sep", "|").csv(f"{workdir}/refined_csv/dim_calendar")
    assert cal.count() == 3 and "Nome do Mês" in cal.columns


def test_run_lake_end_to_end_and_incremental(spark, workdir):
    from lakestrata.plans.lake import LakePaths, run_lake
    src = f"{workdir}/src"
    os.makedirs(f"{src}/general"); os.makedirs(f"{src}/us")
    write_raw(src)
    paths = LakePaths(f"{workdir}/lake")
    dirs = {"general": f"{src}/general", "us": f"{src}/us"}
    first = run_lake(spark, paths, dirs, verify=True)
    assert first == {"missing": {"general": 2, "us": 2}, "loaded": True,
                     "violations": {"orphan_location_keys": 0, "duplicate_location_keys": 0,
                                    "duplicate_dates": 0, "series_mismatch": 0,
                                    "rows_source_raw": 0, "rows_raw_quality": 0, "rows_quality_trusted": 0,
                                    "rows_trusted_fact": 0, "rows_trusted_published": 0}}
    fact = spark.read.parquet(f"{paths.refined}/fato_covid")
    assert fact.count() == 10
    again = run_lake(spark, paths, dirs)
    assert again == {"missing": {"general": 0, "us": 0}, "loaded": False}
    with open(f"{src}/general/01-03-2021.csv", "w") as f:
        f.write(GENERAL_HEADER + "\n" + ',,S1,C1,2021-01-03 05:00:00,45.5,10.1,21,1,0,20,"S1, C1",13,4.76\n')
    third = run_lake(spark, paths, dirs)
    assert third == {"missing": {"general": 1, "us": 0}, "loaded": True}
    trusted = read_trusted(spark, paths.trusted)
    got = trusted.filter((F.col("STATE") == "S1") & (F.col("DATE_ID") == dt.date(2021, 1, 3)))
    assert [(r["CONFIRMED_AC"], r["CONFIRMED"]) for r in got.collect()] == [(21, 7)]
    assert spark.read.parquet(f"{paths.refined}/fato_covid").count() == 11


def test_command_line_run(spark, workdir):
    from lakestrata.__main__ import main
    src = f"{workdir}/src"
    write_raw(src)
    out = main(["--root", f"{workdir}/lake", "--general", f"{src}/general", "--us", f"{src}/us",
                "--verify", "--no-tune"])
    assert out["loaded"] is True
    assert set(out["violations"].values()) == {0}


def test_run_lake_with_two_general_layouts(spark, workdir):
    from lakestrata.plans.lake import LakePaths, run_lake
    src = f"{workdir}/src"
    write_raw(src)
    swapped = GENERAL_HEADER.replace("Confirmed,Deaths", "Deaths,Confirmed")
    os.makedirs(f"{src}/general_v2")
    with open(f"{src}/general_v2/01-03-2021.csv", "w") as f:
        f.write(swapped + "\n" + ',,S1,C1,2021-01-03 05:00:00,45.5,10.1,2,21,0,20,"S1, C1",13,4.76\n')
    paths = LakePaths(f"{workdir}/lake")
    out = run_lake(spark, paths, {"general": [f"{src}/general", f"{src}/general_v2"],
                                  "us": f"{src}/us"}, verify=True)
    assert out["missing"] == {"general": 3, "us": 2}
    t = read_trusted(spark, paths.trusted).filter(F.col("DATE_ID") == dt.date(2021, 1, 3)).first()
    assert (t["CONFIRMED_AC"], t["DEATHS_AC"], t["CONFIRMED"]) == (21, 2, 7)


DAY3 = ',,S1,C1,2021-01-03 05:00:00,45.5,10.1,21,1,0,20,"S1, C1",13,4.76'


def all_rows(spark, paths):
    return rows(read_trusted(spark, paths.trusted))


def whole(spark, paths):
    """The trusted table made in one go from the raw zone."""
    from lakestrata.plans.lake import raw_rows
    return rows(raw_to_trusted(raw_rows(spark, paths, "general"), raw_rows(spark, paths, "us")))


def test_incremental_days_equal_a_whole_run(spark, workdir):
    from lakestrata.plans.lake import LakePaths, run_lake
    src = f"{workdir}/src"
    write_raw(src)
    paths, dirs = LakePaths(f"{workdir}/lake"), {"general": f"{src}/general", "us": f"{src}/us"}
    run_lake(spark, paths, dirs)
    untouched = sorted(glob.glob(f"{paths.trusted}/DATE_ID=2021-01-01/*"))
    with open(f"{src}/general/01-03-2021.csv", "w") as f:
        f.write(GENERAL_HEADER + "\n" + DAY3 + "\n")
    with open(f"{src}/us/01-03-2021.csv", "w") as f:
        f.write(US_HEADER + "\n")  # a day without rows
    out = run_lake(spark, paths, dirs, verify=True)
    assert out["missing"] == {"general": 1, "us": 1} and set(out["violations"].values()) == {0}
    assert all_rows(spark, paths) == whole(spark, paths)
    assert sorted(glob.glob(f"{paths.trusted}/DATE_ID=2021-01-01/*")) == untouched
    assert run_lake(spark, paths, dirs)["missing"] == {"general": 0, "us": 0}


def test_run_that_fails_anywhere_is_finished_by_the_next(spark, workdir, monkeypatch):
    import lakestrata.plans.lake as lake
    for step in ("build_quality", "publish_refined", "_record"):
        src = f"{workdir}/{step}"
        write_raw(src)
        paths, dirs = lake.LakePaths(f"{src}/lake"), {"general": f"{src}/general", "us": f"{src}/us"}

        def fails(*a, **k):
            raise RuntimeError("stopped")
        with monkeypatch.context() as m:
            m.setattr(lake, step, fails)
            try:
                lake.run_lake(spark, paths, dirs)
            except RuntimeError:
                pass
        out = lake.run_lake(spark, paths, dirs, verify=True)
        assert set(out["violations"].values()) == {0}, step
        assert spark.read.parquet(f"{paths.refined}/fato_covid").count() == 10


def test_zones_run_alone(spark, workdir):
    from lakestrata.plans.lake import LakePaths, run_lake
    write_raw(workdir)
    paths, dirs = LakePaths(f"{workdir}/lake"), {"general": f"{workdir}/general", "us": f"{workdir}/us"}
    run_lake(spark, paths, dirs, steps=["load"])
    assert not os.path.exists(paths.trusted)
    run_lake(spark, paths, dirs, steps=["trusted"])
    assert read_trusted(spark, paths.trusted).count() == 10 and not os.path.exists(paths.refined)
    run_lake(spark, paths, dirs, steps=["refined"])
    assert spark.read.parquet(f"{paths.refined}/fato_covid").count() == 10


def test_old_headers_are_read_by_alias_and_lacking_ones_fail(spark, workdir):
    import pytest
    from lakestrata.plans.lake import LakePaths, run_lake
    write_raw(workdir)
    old = f"{workdir}/general/12-31-2020.csv"
    with open(old, "w") as f:
        f.write("Province/State,Country/Region,Last Update,Confirmed,Deaths,Recovered\nS1,C1,2020-12-31,7,0,0\n")
    paths, dirs = LakePaths(f"{workdir}/lake"), {"general": f"{workdir}/general", "us": f"{workdir}/us"}
    out = run_lake(spark, paths, dirs, verify=True)
    assert set(out["violations"].values()) == {0}
    got = read_trusted(spark, paths.trusted).where("STATE = 'S1' and FONTE = 'GENERAL'").orderBy("DATE_ID").collect()
    assert [(r["CONFIRMED_AC"], r["CONFIRMED"]) for r in got][:2] == [(7, 7), (10, 3)]
    with open(f"{workdir}/general/01-04-2021.csv", "w") as f:
        f.write("State,Country_Region,Last_Update,Confirmed,Deaths,Recovered\nS1,C1,2021-01-04,7,0,0\n")
    with pytest.raises(Exception, match="Province_State.*01-04-2021"):
        run_lake(spark, paths, dirs)


def test_date_from_the_file_key(spark, workdir):
    from lakestrata.plans.lake import LakePaths, run_lake
    write_raw(workdir)
    paths, dirs = LakePaths(f"{workdir}/lake"), {"general": f"{workdir}/general", "us": f"{workdir}/us"}
    run_lake(spark, paths, dirs, date_column="DATE_KEY", date_formats=["MM-dd-yyyy"])
    days = {r[0] for r in read_trusted(spark, paths.trusted).select("DATE_ID").distinct().collect()}
    assert days == {dt.date(2021, 1, 1), dt.date(2021, 1, 2)}


def test_rows_of_one_day_are_ordered_by_time_whatever_their_order(spark, workdir):
    head = GENERAL_HEADER
    lines = [f',,S,C,2021-01-01 0{h}:00:00,1,1,{n},0,0,0,"x",1,1' for h, n in ((1, 10), (2, 15), (3, 30))]
    got = []
    for name, order in (("a", lines), ("b", lines[::-1])):
        write_raw(f"{workdir}/{name}")
        with open(f"{workdir}/{name}/general/01-01-2021.csv", "w") as f:
            f.write(head + "\n" + "\n".join(order) + "\n")
        g, u = raw(spark, f"{workdir}/{name}")
        t = raw_to_trusted(g, u).where("STATE = 'S'")
        got.append(rows(t, "CONFIRMED_AC", "CONFIRMED"))
    assert got[0] == got[1] == [(10, 10), (15, 5), (30, 15)]
