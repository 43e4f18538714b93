"""A star is published whole or not at all, wherever a run stops."""

import datetime as dt
import shutil

import pytest

from lakestrata import schemas as S
from lakestrata.plans import refined as R
from lakestrata.sources import commit as C
from lakestrata.sources.sinks import write_table
from tests.conftest import rows

NAMES = ("fato_covid", "dim_location", "dim_calendar", "base_trusted")


def trusted(spark, places, days, value):
    day = lambda d: None if d is None else dt.date(2021, 1, d)
    data = [("GENERAL", f"S{p}", f"C{p}", day(d), "1", "2", value, 0, 0, 0, None, 1.0, value, 0, 0, 0) for p in places for d in days]
    return spark.createDataFrame(data, S.TRUSTED)


def star(spark, root):
    return {n: rows(R.read_refined(spark, root, n)) for n in NAMES}


class Stop(Exception):
    pass


def stop_at(monkeypatch, number):
    """The ``number``-th change of names, or write of a table, fails instead."""
    done = [0]

    def counted(f):
        def run(*a, **k):
            done[0] += 1
            if done[0] > number:
                raise Stop
            return f(*a, **k)
        return run
    monkeypatch.setattr(R, "write_table", counted(write_table))
    for name in ("rename", "delete", "create"):
        monkeypatch.setattr(C.Files, name, counted(getattr(C.Files, name)))
    return done


@pytest.mark.parametrize("partial", [False, True])
def test_a_run_that_stops_anywhere_leaves_a_whole_star(spark, workdir, monkeypatch, partial):
    def old(root):
        R.publish_refined(R.refine(trusted(spark, "ab", [1, 2, 3, None], 1)), root)

    def new(root):
        t = trusted(spark, "abc", [1, 2, 3, 4, None], 2)
        if partial:
            t = trusted(spark, "ab", [1, 2, None], 1).unionByName(trusted(spark, "abc", [3, 4], 2))
        R.publish_refined(R.refine(t), root, from_day=dt.date(2021, 1, 3) if partial else None)

    old(f"{workdir}/old")
    before = star(spark, f"{workdir}/old")
    shutil.copytree(f"{workdir}/old", f"{workdir}/new")
    new(f"{workdir}/new")
    after = star(spark, f"{workdir}/new")
    assert before != after and len(after["fato_covid"]) == (12 if partial else 15)
    seen = []
    for number in range(4 if partial else 0, 40):  # the tables' writes are those of the other run
        root = f"{workdir}/{number}"
        shutil.copytree(f"{workdir}/old", root)
        with monkeypatch.context() as m:
            stop_at(m, number)
            try:
                new(root)
                stopped = False
            except Stop:
                stopped = True
        got = star(spark, root)
        assert got in (before, after), number
        seen.append(got == after)
        if not stopped:
            break
        C.finish(spark, root)
        assert star(spark, root) == (after if seen[-1] else before)
    else:
        raise AssertionError("never ended")
    assert seen[0] is False and seen[-1] is True and sorted(seen) == seen and sum(seen) > 2


def test_the_next_run_finishes_a_stopped_one(spark, workdir, monkeypatch):
    root = f"{workdir}/star"
    R.publish_refined(R.refine(trusted(spark, "a", [1], 1)), root)
    with monkeypatch.context() as m:
        m.setattr(C, "finish", lambda *a: (_ for _ in ()).throw(Stop()))
        with pytest.raises(Stop):
            R.publish_refined(R.refine(trusted(spark, "ab", [1, 2], 5)), root)
    assert len(star(spark, root)["fato_covid"]) == 4
    R.publish_refined(R.refine(trusted(spark, "abc", [2], 7)), root, from_day=dt.date(2021, 1, 2))
    fact = rows(R.read_refined(spark, root, "fato_covid"), "LOCATION_KEY", "DATE_ID", "CONFIRMED")
    assert sorted((k, d.day, v) for k, d, v in fact) == [("SaCa", 1, 5), ("SaCa", 2, 7), ("SbCb", 1, 5), ("SbCb", 2, 7), ("ScCc", 2, 7)]
    assert not C.Files(spark, root).exists(f"{root}/{C.MARK}")


def test_only_the_given_days_are_replaced(spark, workdir):
    root = f"{workdir}/star"
    R.publish_refined(R.refine(trusted(spark, "a", [1, 2, 3, None], 1)), root, fmt="csv")
    days = spark.createDataFrame([(dt.date(2021, 1, 2),), (None,)], "DATE_ID date")
    R.publish_refined(R.refine(trusted(spark, "a", [1, 2, 3, None], 9)), root, fmt="csv", days=days)
    fact = R.read_refined(spark, root, "fato_covid", "csv")
    assert sorted((str(r.DATE_ID), r.CONFIRMED) for r in fact.collect()) == [("2021-01-01", "1"), ("2021-01-02", "9"), ("2021-01-03", "1"), ("None", "9")]


def report(path, header, lines):
    import os
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(header + "\n" + "\n".join(lines) + "\n")


HEADER = "Province_State,Country_Region,Last_Update,Lat,Long_,Confirmed,Deaths,Recovered,Active,Incident_Rate,Case_Fatality_Ratio,Admin2"


def line(place, day, value):
    at = "" if day is None else f"2021-01-{day:02} 05:00:00"
    return f"S{place},C{place},{at},1,1,{value},1,0,{value},1,1,"


def test_a_late_file_rewrites_the_rows_of_its_series_only(spark, workdir, monkeypatch):
    import glob

    import lakestrata.plans.lake as lake
    src = f"{workdir}/src"
    for d in range(1, 9):
        report(f"{src}/general/{d}.csv", HEADER, [line(p, d, 10 * d + i) for i, p in enumerate("abcd") if not (p == "b" and d in (3, 5))])
    report(f"{src}/us/1.csv", HEADER.replace("Case_Fatality_Ratio", "Mortality_Rate"), [line("x", 1, 5)])
    paths, dirs = lake.LakePaths(f"{workdir}/lake"), {"general": f"{src}/general", "us": f"{src}/us"}
    lake.run_lake(spark, paths, dirs)
    files = lambda: {f: f.split("DATE_ID=")[1][:10] for f in glob.glob(f"{paths.trusted}/DATE_ID=*/*")}
    old = files()
    report(f"{src}/general/late.csv", HEADER, [line("b", 3, 31)])
    computed = []
    whole = lake.trusted_from_quality
    monkeypatch.setattr(lake, "trusted_from_quality", lambda q, **k: (computed.append(rows(q, "STATE", "DATE_ID")), whole(q, **k))[1])
    out = lake.run_lake(spark, paths, dirs, verify=True)
    assert out["missing"] == {"general": 1, "us": 0} and set(out["violations"].values()) == {0}
    # Only b's rows, from the last one before the late day on; only days that have such rows are rewritten.
    assert [{(r[0], r[1].day) for r in c} for c in computed] == [{("Sb", d) for d in (2, 3, 4, 6, 7, 8)}]
    assert {old[f] for f in old.keys() - files().keys()} == {f"2021-01-0{d}" for d in (3, 4, 6, 7, 8)}
    from lakestrata.plans.trusted import raw_to_trusted
    assert rows(lake.read_trusted(spark, paths.trusted)) == rows(raw_to_trusted(
        lake.raw_rows(spark, paths, "general"), lake.raw_rows(spark, paths, "us")))


def test_files_in_any_order_give_the_table_of_a_whole_run(spark, workdir):
    import random

    import lakestrata.plans.lake as lake
    from lakestrata.plans.trusted import raw_to_trusted
    rnd, src = random.Random(4), f"{workdir}/src"
    us = HEADER.replace("Case_Fatality_Ratio", "Mortality_Rate")
    paths, dirs = lake.LakePaths(f"{workdir}/lake"), {"general": f"{src}/general", "us": f"{src}/us"}
    for run in range(3):
        for k in range(3):
            kind = rnd.choice(["general", "us"]) if run else ("general", "us", "us")[k]
            lines = [line(rnd.choice("abc"), rnd.choice([None, *range(1, 9)]), rnd.choice(["", rnd.randint(0, 99)])) for _ in range(rnd.randint(0, 6))]
            report(f"{src}/{kind}/{run}-{k}.csv", us if kind == "us" else HEADER, lines)
        out = lake.run_lake(spark, paths, dirs, verify=True)
        assert all(v == 0 for k, v in out["violations"].items() if k != "series_mismatch")
        want = rows(raw_to_trusted(lake.raw_rows(spark, paths, "general"), lake.raw_rows(spark, paths, "us")))
        assert rows(lake.read_trusted(spark, paths.trusted)) == want
        fact = rows(R.read_refined(spark, paths.refined, "fato_covid"), "DATE_ID", "CONFIRMED")
        assert fact == rows(lake.read_trusted(spark, paths.trusted), "DATE_ID", "CONFIRMED")


def test_dimensions_after_many_loads_are_those_of_a_whole_build(spark, workdir, monkeypatch):
    import lakestrata.plans.lake as lake
    src = f"{workdir}/src"
    paths, dirs = lake.LakePaths(f"{workdir}/lake"), {"general": f"{src}/general", "us": f"{src}/us"}
    report(f"{src}/us/0.csv", HEADER.replace("Case_Fatality_Ratio", "Mortality_Rate"), [line("x", 4, 5)])
    loads = [[("a", 5, 1), ("b", 5, 1)], [("c", 6, 1)], [("a", 2, 1), ("d", None, 3)], [], [("b", None, 9), ("e", 9, 1)]]
    read = []
    whole = lake.refine_more
    monkeypatch.setattr(lake, "refine_more", lambda s, t, new, *a, **k: (read.append(new.count()), whole(s, t, new, *a, **k))[1])
    for n, lines in enumerate(loads):
        # The same place with other coordinates on each day: the first row's count.
        report(f"{src}/general/{n}.csv", HEADER, [line(p, d, v).replace(",1,1,", f",{d or 0},{n},", 1) for p, d, v in lines])
        lake.run_lake(spark, paths, dirs)
        want = R.refine(R.read_trusted(spark, paths.trusted))
        for name in ("dim_location", "dim_calendar", R.STATE):
            got = R.read_refined(spark, paths.refined, name)
            assert rows(got) == rows(want[name].select(*got.columns)), (n, name)
    assert read == [len(lines) for lines in loads[1:]]
