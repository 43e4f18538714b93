import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from lakestrata.functions.casts import as_date, as_decimal, as_double, as_int, as_long, cast_columns
from lakestrata.functions.keys import composite_key, file_name, partition_value, strip_suffix


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_int_written_as_float(spark):
    assert one(spark, as_int("v"), "123.0") == 123
    assert one(spark, as_int("v"), "123.7") == 123
    assert one(spark, as_int("v"), "-4") == -4
    assert one(spark, as_int("v"), "abc") is None
    assert one(spark, as_int("v"), "99999999999") is None


def test_long_keeps_all_digits(spark):
    assert one(spark, as_long("v"), "9007199254740993") == 9007199254740993
    assert one(spark, as_long("v"), "12.0") == 12


def test_decimal_half_up_and_overflow(spark):
    assert one(spark, as_decimal("v"), "12.5") == Decimal("13")
    assert one(spark, as_decimal("v"), "-2.5") == Decimal("-3")
    assert one(spark, as_decimal("v"), "12.4") == Decimal("12")
    assert one(spark, as_decimal("v"), "99999999999") is None
    assert one(spark, as_decimal("v", 10, 2), "1.005") == Decimal("1.01")


def test_dates(spark):
    assert one(spark, as_date("v"), "2021-01-02 05:22:33") == dt.date(2021, 1, 2)
    assert one(spark, as_date("v"), "2021-01-02") == dt.date(2021, 1, 2)
    assert one(spark, as_date("v"), "1/22/2020 17:00") is None
    assert one(spark, as_date("v", ["M/d/yyyy H:mm"]), "1/22/2020 17:00") == dt.date(2020, 1, 22)
    assert one(spark, as_date("v", ["M/d/yyyy H:mm"]), "junk") is None


def test_double_of_text(spark):
    assert one(spark, as_double("v"), "90.7") == 90.7
    assert one(spark, as_double("v"), "abc") is None


def test_cast_columns_in_one_projection(spark):
    df = spark.createDataFrame([("1.0", "2.5", "2020-03-01")], "a string, b string, c string")
    out = cast_columns(df, {"a": "int", "b": "decimal(10,0)", "c": "date"})
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["int", "decimal(10,0)", "date"]
    assert tuple(out.first()) == (1, Decimal("3"), dt.date(2020, 3, 1))


def test_file_keys_are_anchored_and_escaped(spark):
    assert one(spark, strip_suffix("v", ".csv"), "xcsv-01.csv") == "xcsv-01"
    assert one(spark, strip_suffix("v", ".csv"), "01-22-2020.csv") == "01-22-2020"
    assert one(spark, strip_suffix("v", ".csv"), "a.csv.bak") == "a.csv.bak"
    assert one(spark, strip_suffix("v", ".csv", True), "01-22-2020.CSV") == "01-22-2020"
    assert one(spark, file_name("v"), "file:/lake/raw/us/01-22-2020.csv") == "01-22-2020.csv"
    assert one(spark, partition_value("v", "DATE_KEY"),
               "file:/lake/raw/DATE_KEY=01-22-2020/part-0.csv") == "01-22-2020"


def test_composite_key(spark):
    df = spark.createDataFrame([("AB", "C"), ("A", "BC"), (None, "C"), ("S", None)],
                               "STATE string, COUNTRY string")
    keys = [r[0] for r in df.select(composite_key(["STATE"], ["COUNTRY"])).collect()]
    assert keys == ["ABC", "ABC", "C", None]
    keys = [r[0] for r in df.select(composite_key(["STATE"], ["COUNTRY"], sep="|")).collect()]
    assert keys == ["AB|C", "A|BC", "|C", None]
    assert one(spark, F.concat(F.lit("x"), F.col("v")), None) is None


def test_casts_match_python_model_on_random_text(spark):
    import random
    from decimal import ROUND_HALF_UP, Decimal as D
    rnd = random.Random(7)
    texts = []
    for _ in range(400):
        digits = rnd.randint(1, 12)
        whole = str(rnd.randint(0, 10 ** digits - 1))
        frac = "".join(rnd.choice("0123456789") for _ in range(rnd.randint(0, 4)))
        sign = rnd.choice(["", "-"])
        texts.append(f"{sign}{whole}.{frac}" if frac else f"{sign}{whole}")
    texts += ["0.5", "-0.5", "1.5", "2.5", "-2.5", "2147483647", "2147483648", "-2147483649"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = df.select("v", as_int("v").alias("i"), as_decimal("v").alias("d"),
                    as_long("v").alias("l")).collect()
    for r in got:
        exact = D(r["v"])
        rounded = exact.quantize(D(1), rounding=ROUND_HALF_UP)
        assert r["d"] == (rounded if abs(rounded) < D(10) ** 10 else None), r
        truncated = int(float(r["v"]))
        assert r["i"] == (truncated if -2 ** 31 <= truncated < 2 ** 31 else None), r
        assert r["l"] == truncated, r


def test_sql_and_column_cast_paths_agree(spark):
    from lakestrata.functions.casts import typed
    texts = ["12.5", "-2.5", "123.0", "abc", None, "99999999999", "9007199254740993",
             "2021-01-02 05:22:33", "1/22/2020 17:00", " 7 ", "1e3", "-0.0"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    for kind in ["string", "double", "int", "long", "decimal(10,0)", "decimal(12,2)", "date"]:
        fmts = ["M/d/yyyy H:mm"] if kind == "date" else []
        out = df.select(typed("v", kind, fmts).alias("a"), typed(F.col("v"), kind, fmts).alias("b"))
        assert all(r["a"] == r["b"] for r in out.collect()), kind


def test_int_casts_equal_the_lenient_ones_on_any_text(spark):
    import random
    rnd = random.Random(3)
    texts = ["12d", "7f", "0x1p3", "1e3", "1E3", "", " ", ".", "+", "-", ".5", "+.5", "-.5", "5.", "-5.", "+5", "--5", "5-", "1 2",
             "\t7\n", "\x007", "7\x7f", "1.2.3", "1.x", "NaN", "Infinity", "9223372036854775807", "9223372036854775808",
             "9007199254740993.5", "-2147483648.9", "2147483648", "00012", "1_000", "\u0663", "\u00a07", "1,5"]
    texts += ["".join(rnd.choice("0123456789.+-eEdfx \t") for _ in range(rnd.randint(1, 6))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        want = {r["v"]: (r["i"], r["l"]) for r in df.selectExpr("v", "cast(v as int) i", "cast(v as long) l").collect()}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    got = {r["v"]: (r["i"], r["l"]) for r in df.select("v", as_int("v").alias("i"), as_long("v").alias("l")).collect()}
    assert {k: (got[k], want[k]) for k in want if got[k] != want[k]} == {}
