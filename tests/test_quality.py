from decimal import Decimal

from lakestrata.operators.quality import (
    COVID_GATE, COVID_RULES, PASS, Rule, annotate, gate, ratio, ratio_check, report,
)

SCHEMA = ("LAT string, LONG string, CONFIRMED int, DEATHS int, RECOVERED int, ACTIVE int, "
          "INCIDENT_RATE decimal(10,0), CASE_FATALITY_RATIO decimal(10,0)")


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def labels(df, name):
    return [r[0] for r in df.select(name).collect()]


def test_latitude_rules(spark):
    df = frame(spark, [("45.5", "10", 1, 0, 0, 1, Decimal(1), Decimal(0)),
                       ("90.7", "10", 1, 0, 0, 1, Decimal(1), Decimal(0)),
                       ("abc", "10", 1, 0, 0, 1, Decimal(1), Decimal(0)),
                       (None, "10", 1, 0, 0, 1, Decimal(1), Decimal(0)),
                       ("-90", "-180", 1, 0, 0, 1, Decimal(1), Decimal(0))])
    out = annotate(df, COVID_RULES)
    assert labels(out, "teste_range_lat") == [PASS, "latitude_fora_range", "latitude_fora_range",
                                              "sem_latitude", PASS]
    assert labels(out, "teste_completude_lat") == [PASS, PASS, PASS, "sem_latitude", PASS]
    assert labels(out, "teste_range_long") == [PASS] * 5


def test_sign_rules(spark):
    df = frame(spark, [("1", "1", -1, None, 0, 5, Decimal(-3), None)])
    out = annotate(df, COVID_RULES).first()
    assert out["teste_confirmed"] == "confirmed_negativos"
    assert out["teste_deaths"] == "deaths_nulos"
    assert out["teste_recovered"] == PASS
    assert out["teste_active"] == PASS
    assert out["teste_incident_rate"] == "incident_rate_negativos"
    assert out["teste_case_fatality_ratio"] == "case_fatality_ratio_nulos"


def test_ratio_zero_and_check(spark):
    df = frame(spark, [("1", "1", 0, 0, 0, 0, Decimal(0), Decimal(0)),
                       ("1", "1", 200, 5, 0, 0, Decimal(0), Decimal(3)),
                       ("1", "1", 300, 7, 0, 0, Decimal(0), Decimal(2))])
    out = df.select(ratio("DEATHS", "CONFIRMED").alias("r"),
                    ratio_check("DEATHS", "CONFIRMED", "CASE_FATALITY_RATIO").alias("c"),
                    ratio_check("DEATHS", "CONFIRMED", "CASE_FATALITY_RATIO",
                                tolerance=0.5).alias("t")).collect()
    assert out[0]["r"] is None and out[0]["c"] is None
    assert out[1]["r"] == 2.5 and out[1]["c"] is False and out[1]["t"] is True
    assert abs(out[2]["r"] - 7 / 300 * 100) < 1e-12
    assert out[2]["c"] is False and out[2]["t"] is True


def test_gate_and_report_add_up(spark):
    df = frame(spark, [("1", "1", 1, 1, 1, 1, Decimal(1), Decimal(1)),
                       (None, "1", 1, 1, 1, 1, Decimal(1), Decimal(1)),
                       ("1", "1", -1, 1, 1, 1, Decimal(1), None)])
    out = annotate(df, COVID_RULES)
    assert gate(out, COVID_GATE).count() == 1
    rep = report(out, COVID_RULES)
    per_rule = {r["RULE"]: 0 for r in rep.collect()}
    for r in rep.collect():
        per_rule[r["RULE"]] += r["N"]
    assert set(per_rule) == {r.name for r in COVID_RULES}
    assert all(n == 3 for n in per_rule.values())
    got = {(r["RULE"], r["LABEL"]): r["N"] for r in rep.collect()}
    assert got[("teste_confirmed", "confirmed_negativos")] == 1
    assert got[("teste_case_fatality_ratio", "case_fatality_ratio_nulos")] == 1


def test_custom_rule_on_text(spark):
    df = spark.createDataFrame([("5",), ("5000.5",), (None,)], "v string")
    r = Rule("t", "v", "range", "none", "out", 0, 5000)
    assert labels(annotate(df, [r]), "t") == [PASS, "out", "none"]


def test_gate_without_rules_keeps_all(spark):
    df = frame(spark, [("1", "1", 1, 1, 1, 1, Decimal(1), Decimal(1))])
    assert gate(df, []).count() == 1
