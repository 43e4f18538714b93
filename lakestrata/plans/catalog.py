"""Every operator shown on the driver's tables, with an independent SQL oracle.

The snapshot lake's own inputs are not part of the test data, so each
operator runs here on the star-schema tables (orders, lineitem, customer,
...) mapped onto the operator's roles: a customer is a location, an order
total a counter snapshot, an order key a file key.  Each ``q_*`` takes
``(spark, sf_dir)`` and returns a lazy DataFrame over whole tables;
``ORACLE`` holds the same result as SQL over the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lakestrata.functions.casts import as_date, quote_ident, typed
from lakestrata.functions.keys import partition_value, source_url
from lakestrata.operators.harmonise import SourceMap, harmonise, keep_null
from lakestrata.operators.quality import Rule, annotate, gate, ratio, ratio_check, report
from lakestrata.operators.reconcile import (
    has_pending, load_missing, missing_keys, pending_count, with_target,
)
from lakestrata.operators.series import cumulative_to_daily, lag_value
from lakestrata.operators.star import calendar_dim, fact, location_dim, with_location_key
from lakestrata.plans.ingest import (
    find_missing, ingest_missing, keyed_source, lake_listing, read_missing, record_loaded, write_missing,
)
from lakestrata.plans.refined import publish_refined, read_trusted, refine
from lakestrata.session import scratch_path
from lakestrata.sources.csv import (
    read_csv, read_csv_strings, read_or_empty, read_partitioned_csv,
)
from lakestrata.sources.listing import HREF_LINK, file_keys, list_files, page_links
from lakestrata.sources.sinks import write_csv, write_single_csv, write_table

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------------
# harmonise: two layouts -> one typed table


ENTITY_COLUMNS = ["FONTE", "ENTITY_KEY", "NAME", "NATION_KEY", "BALANCE"]
ENTITY_CASTS = {"ENTITY_KEY": "long", "NAME": "string", "NATION_KEY": "int",
                "BALANCE": "double"}


def _as_text(df: DataFrame) -> DataFrame:
    """Every column as text, the way a raw CSV arrives."""
    return df.selectExpr(*[f"CAST({quote_ident(c)} AS STRING) AS {quote_ident(c)}"
                           for c in df.columns])


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _as_text(table(spark, sf_dir, "customer"))
    supplier = _as_text(table(spark, sf_dir, "supplier"))
    return harmonise(
        [(customer, SourceMap("CUSTOMER", {"c_custkey": "ENTITY_KEY", "c_name": "NAME",
                                           "c_nationkey": "NATION_KEY",
                                           "c_acctbal": "BALANCE"})),
         (supplier, SourceMap("SUPPLIER", {"s_suppkey": "ENTITY_KEY", "s_name": "NAME",
                                           "s_nationkey": "NATION_KEY",
                                           "s_acctbal": "BALANCE"}))],
        ENTITY_COLUMNS, ENTITY_CASTS, tag_col="FONTE")


def q_harmonise_sources(spark, sf_dir):
    return entities(spark, sf_dir)


def q_filter_null(spark, sf_dir):
    c = table(spark, sf_dir, "customer").withColumn(
        "c_mktsegment", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")))
    return keep_null(c, "c_mktsegment")


def q_typed_casts(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    raw = o.select(
        "o_orderkey",
        F.col("o_totalprice").cast("string").alias("PRICE_TEXT"),
        F.when(F.col("o_orderpriority") == "1-URGENT",
               F.date_format("o_orderdate", "M/d/yyyy H:mm"))
        .otherwise(F.col("o_orderdate").cast("string")).alias("DATE_TEXT"))
    return raw.select(
        "o_orderkey",
        typed("o_orderkey", "string").alias("KEY_STR"),
        typed("PRICE_TEXT", "int").alias("PRICE_INT"),
        typed("PRICE_TEXT", "decimal(10,0)").alias("PRICE_DEC"),
        as_date("DATE_TEXT").alias("ORDER_DATE"),
        as_date("DATE_TEXT", ["M/d/yyyy H:mm"]).alias("ORDER_DATE_ANY"))


# --------------------------------------------------------------------------
# quality labels on the harmonised table


# Labels of the rules we run on the entity table.
ENTITY_RULES = {
    "completeness": [
        Rule("teste_completude_nome", "NAME", "present", "sem_nome"),
        Rule("teste_completude_nacao", "NATION_KEY", "present", "sem_nacao"),
    ],
    "range": [
        Rule("teste_range_saldo", "BALANCE_TEXT", "range", "sem_saldo", "saldo_fora_range",
             -500, 5000),
    ],
    "sign": [
        Rule("teste_saldo", "BALANCE", "non_negative", "saldo_nulos", "saldo_negativos"),
        Rule("teste_nacao", "NATION_KEY", "non_negative", "nacao_nulos", "nacao_negativos"),
    ],
}
ALL_ENTITY_RULES = [r for rs in ENTITY_RULES.values() for r in rs]


def entities_with_gaps(spark, sf_dir):
    """Entities where negative balances hide the name and nation 0 is unknown."""
    e = entities(spark, sf_dir)
    return e.withColumns({
        "NAME": F.when(F.col("BALANCE") < 0, F.lit(None).cast("string")).otherwise(F.col("NAME")),
        "NATION_KEY": F.nullif(F.col("NATION_KEY"), F.lit(0)),
        "BALANCE_TEXT": F.col("BALANCE").cast("string"),
    })


def _labelled(spark, sf_dir, rules):
    out = annotate(entities_with_gaps(spark, sf_dir), rules)
    return out.select(*ENTITY_COLUMNS, *[r.name for r in rules])


def q_quality_completeness(spark, sf_dir):
    return _labelled(spark, sf_dir, ENTITY_RULES["completeness"])


def q_quality_range(spark, sf_dir):
    return _labelled(spark, sf_dir, ENTITY_RULES["range"])


def q_quality_sign(spark, sf_dir):
    return _labelled(spark, sf_dir, ENTITY_RULES["sign"])


def q_quality_labels(spark, sf_dir):
    return _labelled(spark, sf_dir, ALL_ENTITY_RULES)


def q_quality_gate(spark, sf_dir):
    labelled = _labelled(spark, sf_dir, ALL_ENTITY_RULES)
    return gate(labelled, [r.name for r in ALL_ENTITY_RULES]).select(*ENTITY_COLUMNS)


def q_quality_report(spark, sf_dir):
    return report(_labelled(spark, sf_dir, ALL_ENTITY_RULES), ALL_ENTITY_RULES)


def _ratios(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_tax",
                                                 "l_discount")
    return li.withColumn("RATIO", ratio("l_tax", "l_discount"))


def q_derived_ratio(spark, sf_dir):
    return _ratios(spark, sf_dir)


def q_quality_ratio_check(spark, sf_dir):
    r = _ratios(spark, sf_dir).withColumn(
        "REPORTED", typed(F.col("RATIO").cast("string"), "decimal(10,0)"))
    return r.select("l_orderkey", "l_linenumber", "RATIO", "REPORTED",
                    ratio_check("l_tax", "l_discount", "REPORTED").alias("RATIO_OK"))


# --------------------------------------------------------------------------
# series


def q_lag_value(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    return lag_value(ev, ["user_id"], ["ts", "event_id"], "value", "PREV_VALUE")


def q_lag_hot_key(spark, sf_dir):
    """Lag per event type: five keys, each a fifth of the table, split where they pass a thousand rows."""
    ev = table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    return lag_value(ev, ["event_type"], ["ts", "event_id"], "value", "PREV_VALUE", split_above=1000)


def q_lag_bucketed(spark, sf_dir):
    """The same lag with every key split."""
    ev = table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    return lag_value(ev, ["event_type"], ["ts", "event_id"], "value", "PREV_VALUE",
                     split_above=0)


def q_lag_hot_bucket(spark, sf_dir):
    """One key and one day for all rows, ordered by texts that begin alike."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", F.lit("all").alias("SERIES"), F.lit("2024-01-01").cast("date").alias("DAY"),
        F.concat(F.lit("common-prefix-of-all-"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("LABEL"), "value")
    return lag_value(ev, ["SERIES"], ["DAY", "LABEL"], "value", "PREV_VALUE", split_above=1000)


def q_lag_by_number(spark, sf_dir):
    """A hot key ordered by a number."""
    ev = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return lag_value(ev, ["event_type"], ["event_id"], "value", "PREV_VALUE", split_above=500)


def q_daily_with_ties(spark, sf_dir):
    """Lines of an order as counter rows of one (customer, day, status): their order is the rest of the row's.

    The result is the same for any order of the input, so it is taken over the rows both ways round.
    """
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    rows = o.join(li, o.o_orderkey == li.l_orderkey).select(
        F.col("o_custkey"), F.col("o_orderdate").cast("date").alias("DATE_ID"), F.col("o_orderstatus").alias("FONTE"),
        F.col("l_quantity").alias("QUANTITY"), F.col("l_extendedprice").alias("PRICE"))
    path = scratch_path(spark, "order-lines")
    rows.write.parquet(path)
    rows = spark.read.parquet(path)
    daily = [cumulative_to_daily(x.withColumn("TIE", F.struct("FONTE", F.col("QUANTITY").alias("q"), F.col("PRICE").alias("p"))),
                                 ["o_custkey"], ["DATE_ID"], ["QUANTITY", "PRICE"], tiebreak=["TIE"]).drop("TIE")
             for x in (rows, rows.orderBy(F.desc("PRICE")))]
    both = daily[0].withColumn("RUN", F.lit(1)).unionByName(daily[1].withColumn("RUN", F.lit(2)))
    counted = both.groupBy(*daily[0].columns).agg(F.count_if(F.col("RUN") == 1).alias("FIRST"),
                                                  F.count_if(F.col("RUN") == 2).alias("SECOND"))
    return counted


def _snapshots(spark, sf_dir, gaps: bool):
    o = table(spark, sf_dir, "orders")
    total = F.col("o_totalprice")
    if gaps:
        total = F.when(F.nullif(F.col("o_orderstatus"), F.lit("P")).isNull(),
                       F.lit(None).cast("double")).otherwise(total)
    return o.select("o_custkey", F.col("o_orderdate").cast("date").alias("DATE_ID"),
                    "o_orderkey", total.alias("TOTALPRICE"))


def q_cumulative_to_daily(spark, sf_dir):
    return cumulative_to_daily(_snapshots(spark, sf_dir, False), ["o_custkey"], ["DATE_ID"],
                               ["TOTALPRICE"], tiebreak=["o_orderkey"])


def q_cumulative_to_daily_gaps(spark, sf_dir):
    return cumulative_to_daily(_snapshots(spark, sf_dir, True), ["o_custkey"], ["DATE_ID"],
                               ["TOTALPRICE"], tiebreak=["o_orderkey"])


def q_cumulative_to_daily_skip_gaps(spark, sf_dir):
    return cumulative_to_daily(_snapshots(spark, sf_dir, True), ["o_custkey"], ["DATE_ID"],
                               ["TOTALPRICE"], tiebreak=["o_orderkey"], ignore_null_gaps=True)


# --------------------------------------------------------------------------
# star schema


def _customer_locations(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    rows = (c.join(n, c.c_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey)
            .select("c_custkey",
                    F.nullif(F.col("r_name"), F.lit("AMERICA")).alias("STATE"),
                    F.nullif(F.col("n_name"), F.lit("NATION_7")).alias("COUNTRY")))
    return with_location_key(rows)


def q_location_dim(spark, sf_dir):
    dim = location_dim(_customer_locations(spark, sf_dir),
                       attrs=["COUNTRY", "STATE", "c_custkey"], order=["c_custkey"])
    return dim.withColumnRenamed("c_custkey", "FIRST_CUSTKEY")


def q_calendar_dim(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("DATE_ID"))
    return calendar_dim(o)


def _order_facts(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_custkey",
                    F.col("o_orderdate").cast("date").alias("DATE_ID"),
                    F.col("o_orderstatus").alias("FONTE"),
                    F.col("o_totalprice").alias("TOTALPRICE"))


def q_fact_projection(spark, sf_dir):
    return fact(_order_facts(spark, sf_dir),
                ["o_orderkey", "o_custkey", "DATE_ID", "FONTE", "TOTALPRICE"],
                ("DATE_KEY_PART", "DATE_ID"))


def q_sql_null_date(spark, sf_dir):
    o = _order_facts(spark, sf_dir).withColumn(
        "DATE_ID", F.when(F.nullif(F.col("FONTE"), F.lit("P")).isNull(),
                          F.lit(None).cast("date")).otherwise(F.col("DATE_ID")))
    o.createOrReplaceTempView("base_orders")
    return spark.sql("SELECT * FROM base_orders WHERE DATE_ID IS NULL")


def star_fact(spark, sf_dir):
    """Flagship: orders as counter snapshots per (region, nation) location,
    cumulative -> daily, keyed and projected as the fact table."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    base = (o.join(c, o.o_custkey == c.c_custkey)
            .join(n, c.c_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey)
            .select(F.col("r_name").alias("STATE"), F.col("n_name").alias("COUNTRY"),
                    F.col("o_orderdate").cast("date").alias("DATE_ID"),
                    F.col("o_orderstatus").alias("FONTE"), "o_orderkey",
                    F.col("o_totalprice").alias("TOTALPRICE")))
    path = scratch_path(spark, "order-locations")  # the series reads its input more than once
    base.write.parquet(path)
    daily = cumulative_to_daily(spark.read.schema(base.schema).parquet(path), ["STATE", "COUNTRY"], ["DATE_ID"], ["TOTALPRICE"],
                                tiebreak=["FONTE", "o_orderkey"])
    return fact(with_location_key(daily),
                ["LOCATION_KEY", "DATE_ID", "FONTE", "o_orderkey", "TOTALPRICE",
                 "TOTALPRICE_AC"], ("DATE_KEY_PART", "DATE_ID"))


# --------------------------------------------------------------------------
# reconciliation and ingestion


def _order_keys(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey")


def _loaded_order_keys(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))


def _missing_orders(spark, sf_dir):
    return missing_keys(_order_keys(spark, sf_dir), _loaded_order_keys(spark, sf_dir),
                        "o_orderkey")


def _missing_documents(spark, sf_dir):
    return missing_keys(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                        "doc_id")


def q_missing_keys(spark, sf_dir):
    return _missing_orders(spark, sf_dir)


def q_missing_keys_empty_target(spark, sf_dir):
    schema = StructType([StructField("o_orderkey", LongType())])
    absent = scratch_path(spark, "never-written")
    target = read_or_empty(spark, lambda: spark.read.schema(schema).parquet(absent), schema)
    return missing_keys(_order_keys(spark, sf_dir), target, "o_orderkey")


def q_left_join_keys(spark, sf_dir):
    loaded = _loaded_order_keys(spark, sf_dir).distinct().withColumn("Cam_Lake", F.lit("lineitem"))
    source = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return with_target(source, loaded, "o_orderkey", ["Cam_Lake"])


def q_incremental_load(spark, sf_dir):
    return load_missing(table(spark, sf_dir, "documents"), _missing_documents(spark, sf_dir),
                        "doc_id")


def q_pending_count(spark, sf_dir):
    return pending_count(_missing_orders(spark, sf_dir),
                         _missing_documents(spark, sf_dir).select("doc_id"))


def q_page_links(spark, sf_dir):
    return page_links(table(spark, sf_dir, "pages"), pattern=HREF_LINK, tipo="pages",
                      id_cols=["page_id"])


def q_title_links(spark, sf_dir):
    """Titles of data files, made from the pages' addresses in several HTML forms, and links of any extension's case.

    Other attributes, other extensions, second titles, and what stands in comments and scripts are no titles of data files.
    """
    name = F.concat(F.lit("page-"), F.regexp_replace("url", "[^A-Za-z0-9]+", "-"))
    kind = F.col("page_id") % 7
    html = (F.when(kind == 0, F.concat(F.lit('<a title="'), name, F.lit('.csv" href="'), name, F.lit('.CSV">')))
            .when(kind == 1, F.concat(F.lit("<a href='y' title = '"), name, F.lit(".csv'>")))
            .when(kind == 2, F.concat(F.lit("<a TITLE="), name, F.lit(".csv>")))
            .when(kind == 3, F.concat(F.lit('<a data-title="'), name, F.lit('.csv" title="'), name, F.lit('.txt">')))
            .when(kind == 4, F.concat(F.lit("<a\ntitle='a &amp;amp; &#x62;&#45;"), name, F.lit(""" &lt;1&gt;.csv' title="b.csv">""")))
            .when(kind == 5, F.concat(F.lit('<!-- <a title="'), name, F.lit('.csv"> --><b title="'), name, F.lit('-b.csv"/>')))
            .otherwise(F.concat(F.lit("""<script>x = '<a title="y.csv">'</script>title="z.csv" <i x=">" title='"""), name, F.lit(".csv'>"))))
    pages = table(spark, sf_dir, "pages").select("page_id", html.alias("html"))
    return page_links(pages, tipo="General", id_cols=["page_id"]).unionByName(
        page_links(pages, pattern='href="([^"]*)"', tipo="US", id_cols=["page_id"]))


def q_file_listing_keys(spark, sf_dir):
    """Keys of files written from orders, a file per month: name, key and address of each, from the files' listing."""
    months = table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "MM-yyyy").alias("m"), "o_orderkey")
    path = scratch_path(spark, "orders-files")
    _one_file_each(months, "m", path, lambda m: F.concat(m, F.lit(".csv")))
    keys = file_keys(spark, path, name_col="Cam_Lake")
    return keys.withColumn("SOURCE_URL", source_url("raw/", "DATE_KEY", ".csv"))


def _one_file_each(rows, by, path, name, header=None):
    """Rows as CSV files of chosen names, one per value of ``by``: written as folders, then renamed by Hadoop's file system."""
    spark = rows.sparkSession
    parts = path + "-parts"
    columns = [c for c in rows.columns if c != by]
    rows.select(by, *columns).repartition(by).write.partitionBy(by).option("header", True).csv(parts)
    listed = list_files(spark, parts, glob="*.csv", recursive=True, uri=True).select(
        "path", name(partition_value("uri", by)).alias("name")).collect()  # a file a month
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop(path))
    for r in listed:
        fs.rename(hadoop(r["path"]), hadoop(hadoop(path), r["name"]))


def q_incremental_ingest(spark, sf_dir):
    """Orders as one file per month under odd names, loaded in two goes and a third that finds nothing, read back.

    One month's file is empty but for its header, half the files have another column order.
    """
    orders = table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("m"), F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"), "o_orderstatus", "o_orderpriority")
    root = scratch_path(spark, "orders-source")
    odd = lambda m: F.concat(F.lit("o="), F.replace(m, F.lit("-"), F.lit(" 50%+")),
                             F.when(F.substring(m, -1, 1).isin("1", "2"), F.lit(".CSV")).otherwise(F.lit(".csv")))
    late = F.substring("m", -1, 1).cast("int") % 2 == 1
    _one_file_each(orders.where(~late), "m", f"{root}/a", odd)
    swapped = orders.select("m", "o_orderpriority", "o_orderstatus", "o_custkey", "o_orderkey")
    _one_file_each(swapped.where(late), "m", f"{root}/b", odd)
    names = StructType([StructField(c, StringType()) for c in orders.columns[1:]])
    spark.createDataFrame([], names).coalesce(1).write.option("header", True).csv(f"{root}/c")
    lake = scratch_path(spark, "orders-lake")
    for source in ([f"{root}/a"], [f"{root}/a", f"{root}/b"], [f"{root}/a", f"{root}/b", f"{root}/c"], [f"{root}/a", f"{root}/b", f"{root}/c"]):
        offered = file_keys(spark, source[0])
        for more in source[1:]:
            offered = offered.union(file_keys(spark, more))
        missing = find_missing(offered, lake_listing(spark, lake))
        if has_pending(missing):
            path = scratch_path(spark, "missing")
            write_missing(missing, path)
            ingest_missing(spark, source, lake, read_missing(spark, path), columns=names.names)
    schema = StructType([*names.fields, StructField("DATE_KEY", StringType())])
    return read_partitioned_csv(spark, lake, schema)


def q_listing_scan(spark, sf_dir):
    """A month's file each of orders, nine of ten of them recorded as loaded: rows and keys of the files that a scan of the others opens."""
    orders = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("m"), "o_orderkey", "o_custkey")
    source, lake = scratch_path(spark, "orders-files"), scratch_path(spark, "orders-lake")
    _one_file_each(orders, "m", source, lambda m: F.concat(m, F.lit(".csv")))
    offered = file_keys(spark, source)
    month = F.substring("DATE_KEY", 1, 4).cast("int") * 12 + F.substring("DATE_KEY", 6, 2).cast("int")
    record_loaded(offered.where(month % 10 != 0), lake)
    rows = keyed_source(spark, source, columns=["o_custkey", "o_orderkey"], only=find_missing(offered, lake_listing(spark, lake)))
    return rows.groupBy("DATE_KEY").agg(F.count("*").alias("N"), F.sum(typed("o_orderkey", "long")).alias("ORDERS"),
                                        F.countDistinct("o_custkey").alias("CUSTOMERS"))


def q_partition_listing_keys(spark, sf_dir):
    """Orders written as one folder per month key, keys read back from the
    folder listing (the way the raw zone's loaded days are listed)."""
    orders = table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("DATE_KEY"), "o_orderkey", "o_totalprice")
    path = scratch_path(spark, "orders-by-month")
    write_csv(orders, path, partition_by=["DATE_KEY"])
    return lake_listing(spark, path, partition_column="DATE_KEY").select("DATE_KEY").distinct()


# --------------------------------------------------------------------------
# CSV round trips (written below the session's checkpoint folder)


ORDERS_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                  "o_orderpriority"]


def _orders_csv(spark, sf_dir, sep=","):
    path = scratch_path(spark, "orders-csv")
    write_csv(table(spark, sf_dir, "orders"), path, sep=sep)
    return path


def q_csv_scan_strings(spark, sf_dir):
    return read_csv_strings(spark, _orders_csv(spark, sf_dir))


def q_csv_scan_inferred(spark, sf_dir):
    """Types inferred by an extra pass over the file, then keys cast back to
    text.  Inference costs a full scan; the zone readers pass a schema."""
    inferred = read_csv(spark, _orders_csv(spark, sf_dir), infer=True)
    return inferred.select(*[F.col(c).cast("string").alias(c) for c in inferred.columns])


def q_csv_scan_typed(spark, sf_dir):
    schema = table(spark, sf_dir, "orders").schema
    return read_csv(spark, _orders_csv(spark, sf_dir), schema)


def q_csv_roundtrip(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    path = scratch_path(spark, "part-csv")
    write_csv(table(spark, sf_dir, "nation"), path)  # whatever the folder held ...
    write_csv(part, path, mode="overwrite")          # ... is replaced whole
    return read_csv(spark, path, part.schema, sep="|")


def q_csv_single_file_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "missing-list")
    write_single_csv(_missing_orders(spark, sf_dir), path, sep="|")
    schema = StructType([StructField("o_orderkey", LongType())])
    return read_csv(spark, path, schema, sep="|")


def q_csv_partitioned_scan(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders-by-status")
    write_csv(orders, path, sep="|", partition_by=["o_orderstatus"])
    fields = [f for f in orders.schema.fields if f.name != "o_orderstatus"]
    schema = StructType(fields + [orders.schema["o_orderstatus"]])
    scanned = read_partitioned_csv(spark, path, schema, sep="|")
    return scanned.filter(F.col("o_orderstatus") == "F").select(*ORDERS_COLUMNS)


def q_csv_transcode(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier")
    comma = scratch_path(spark, "supplier-comma")
    pipe = scratch_path(spark, "supplier-pipe")
    write_csv(supplier, comma, sep=",")
    write_csv(read_csv(spark, comma, supplier.schema, sep=","), pipe, sep="|")
    return read_csv(spark, pipe, supplier.schema, sep="|")


def q_csv_text_roundtrip(spark, sf_dir):
    """Documents and turns, and values that a careless dialect loses, through a written CSV."""
    docs = table(spark, sf_dir, "documents").select(F.lit("d").alias("T"), F.col("doc_id").alias("ID"), F.col("text").alias("TEXT"))
    turns = table(spark, sf_dir, "conversations").select(
        F.lit("c"), F.col("conv_id") * 1000 + F.col("turn"), "text")
    odd = table(spark, sf_dir, "region").select(F.lit("r"), "r_regionkey", F.when(F.col("r_regionkey") == 0, F.lit(""))
                .when(F.col("r_regionkey") == 1, F.lit("  two blanks  ")).when(F.col("r_regionkey") == 2, F.lit('"a" \\ \\"b|,\n\r\n'))
                .when(F.col("r_regionkey") == 3, F.lit(None).cast("string")).otherwise(F.lit(" ")))
    rows = docs.union(turns).union(odd)
    path = scratch_path(spark, "texts-csv")
    write_csv(rows, path)
    return read_csv(spark, path, rows.schema, sep="|")


def q_csv_timestamp_roundtrip(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    path = scratch_path(spark, "events-csv")
    write_csv(events, path)
    return read_csv(spark, path, events.schema, sep="|")


def q_publish_star(spark, sf_dir):
    """The star of the customers' locations, published and read back: rows and folders of each table.

    Orders of status P have no date.
    """
    c, o = _customer_locations(spark, sf_dir), table(spark, sf_dir, "orders")
    day = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date"))
    rows = o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderstatus").alias("FONTE"), "STATE", "COUNTRY", day.alias("DATE_ID"),
        F.col("o_orderkey").cast("string").alias("LAT"), F.col("o_custkey").cast("string").alias("LONG"),
        *[F.col("o_custkey").cast("int").alias(n) for n in ("CONFIRMED_AC", "DEATHS_AC", "RECOVERED_AC", "ACTIVE_AC")],
        F.lit(None).cast("decimal(10,0)").alias("INCIDENT_RATE"), F.col("o_totalprice").alias("CASE_FATALITY_RATIO"),
        *[F.col("o_custkey").cast("int").alias(n) for n in ("CONFIRMED", "DEATHS", "RECOVERED", "ACTIVE")])
    root = scratch_path(spark, "star")
    write_table(rows, f"{root}/trusted", partition_by=["DATE_ID"])
    publish_refined(refine(read_trusted(spark, f"{root}/trusted")), f"{root}/refined")
    read = lambda n: spark.read.parquet(f"{root}/refined/{n}")
    return (read("fato_covid").groupBy("LOCATION_KEY", "DATE_ID")
            .agg(F.count("*").alias("N"), F.sum("CONFIRMED").alias("CONFIRMED"))
            .join(read("dim_location").select(F.col("LOCATION_KEY").alias("K"), F.col("COUNTRY").alias("PAIS")),
                  F.col("LOCATION_KEY").eqNullSafe(F.col("K")), "left").drop("K")
            .join(read("dim_calendar").select(F.col("DATE_ID").alias("D"), F.lit(1).alias("KNOWN_DATE")),
                  F.col("DATE_ID").eqNullSafe(F.col("D")), "left").drop("D")
            .withColumn("BASE_ROWS", read("base_trusted").agg(F.count("*")).scalar()))


QUERIES: dict[str, Query] = {
    "harmonise_sources": q_harmonise_sources,
    "filter_null": q_filter_null,
    "typed_casts": q_typed_casts,
    "quality_completeness": q_quality_completeness,
    "quality_range": q_quality_range,
    "quality_sign": q_quality_sign,
    "quality_labels": q_quality_labels,
    "quality_ratio_check": q_quality_ratio_check,
    "derived_ratio": q_derived_ratio,
    "quality_gate": q_quality_gate,
    "quality_report": q_quality_report,
    "lag_value": q_lag_value,
    "lag_hot_key": q_lag_hot_key,
    "lag_bucketed": q_lag_bucketed,
    "lag_hot_bucket": q_lag_hot_bucket,
    "lag_by_number": q_lag_by_number,
    "daily_with_ties": q_daily_with_ties,
    "cumulative_to_daily": q_cumulative_to_daily,
    "cumulative_to_daily_gaps": q_cumulative_to_daily_gaps,
    "cumulative_to_daily_skip_gaps": q_cumulative_to_daily_skip_gaps,
    "location_dim": q_location_dim,
    "calendar_dim": q_calendar_dim,
    "fact_projection": q_fact_projection,
    "star_fact": star_fact,
    "sql_null_date": q_sql_null_date,
    "missing_keys": q_missing_keys,
    "missing_keys_empty_target": q_missing_keys_empty_target,
    "left_join_keys": q_left_join_keys,
    "incremental_ingest": q_incremental_ingest,
    "incremental_load": q_incremental_load,
    "listing_scan": q_listing_scan,
    "pending_count": q_pending_count,
    "page_links": q_page_links,
    "title_links": q_title_links,
    "file_listing_keys": q_file_listing_keys,
    "partition_listing_keys": q_partition_listing_keys,
    "csv_scan_strings": q_csv_scan_strings,
    "csv_scan_inferred": q_csv_scan_inferred,
    "csv_scan_typed": q_csv_scan_typed,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_single_file_roundtrip": q_csv_single_file_roundtrip,
    "csv_partitioned_scan": q_csv_partitioned_scan,
    "csv_transcode": q_csv_transcode,
    "csv_text_roundtrip": q_csv_text_roundtrip,
    "csv_timestamp_roundtrip": q_csv_timestamp_roundtrip,
    "publish_star": q_publish_star,
}
