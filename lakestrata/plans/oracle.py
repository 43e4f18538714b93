"""DuckDB SQL for every catalogue query, written independently of the operators.

Traps kept in mind: ``||`` (not ``concat``) so a NULL part gives a NULL key;
windows say NULLS FIRST where a NULL can meet the order; integer calendar
parts are cast to INTEGER; DuckDB's own double -> decimal and double -> int
casts round, so truncation and HALF_UP are spelled out.
"""

from __future__ import annotations

_ENTITIES = """
  SELECT 'CUSTOMER' AS FONTE, c_custkey AS ENTITY_KEY, c_name AS NAME,
         c_nationkey AS NATION_KEY, c_acctbal AS BALANCE FROM customer
  UNION ALL
  SELECT 'SUPPLIER', s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
"""

_GAPPY = f"""
  SELECT FONTE, ENTITY_KEY, CASE WHEN BALANCE < 0 THEN NULL ELSE NAME END AS NAME,
         NULLIF(NATION_KEY, 0) AS NATION_KEY, BALANCE
  FROM ({_ENTITIES}) e
"""

_LABELS = {
    "teste_completude_nome":
        "CASE WHEN NAME IS NULL THEN 'sem_nome' ELSE 'correto' END",
    "teste_completude_nacao":
        "CASE WHEN NATION_KEY IS NULL THEN 'sem_nacao' ELSE 'correto' END",
    "teste_range_saldo":
        "CASE WHEN BALANCE IS NULL THEN 'sem_saldo' "
        "WHEN BALANCE >= -500 AND BALANCE <= 5000 THEN 'correto' ELSE 'saldo_fora_range' END",
    "teste_saldo":
        "CASE WHEN BALANCE IS NULL THEN 'saldo_nulos' "
        "WHEN BALANCE < 0 THEN 'saldo_negativos' ELSE 'correto' END",
    "teste_nacao":
        "CASE WHEN NATION_KEY IS NULL THEN 'nacao_nulos' "
        "WHEN NATION_KEY < 0 THEN 'nacao_negativos' ELSE 'correto' END",
}


def _labelled(names: list[str]) -> str:
    cols = ", ".join(f"{_LABELS[n]} AS {n}" for n in names)
    return f"SELECT FONTE, ENTITY_KEY, NAME, NATION_KEY, BALANCE, {cols} FROM ({_GAPPY}) g"


_ALL = list(_LABELS)

_REPORT = " UNION ALL ".join(
    f"SELECT '{n}' AS RULE, {n} AS LABEL, COUNT(*) AS N FROM l GROUP BY {n}" for n in _ALL)

_RATIO = "l_tax / NULLIF(l_discount, 0) * 100"


def _half_up(x: str) -> str:
    return f"CAST(sign({x}) * floor(abs({x}) + 0.5) AS DECIMAL(10,0))"


_MISSING_ORDERS = """
  SELECT o_orderkey FROM orders o
  WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
"""
_MISSING_DOCS = """
  SELECT d.doc_id FROM documents d
  WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
"""

_SNAP = """
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS DATE_ID, o_orderkey,
         {total} AS TOTALPRICE
  FROM orders
"""
_W_CUST = "PARTITION BY o_custkey ORDER BY DATE_ID, o_orderkey"
_GAP_TOTAL = "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END"

_ORDERS_TEXT = """
  SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
         o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority
  FROM orders
"""

_LAG_BY_TYPE = """
  SELECT event_id, event_type, ts, value,
         LAG(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS PREV_VALUE
  FROM events
"""

ORACLE: dict[str, str] = {
    "harmonise_sources": _ENTITIES,
    "filter_null": """
        SELECT c_custkey, c_name, c_nationkey, c_acctbal,
               NULLIF(c_mktsegment, 'BUILDING') AS c_mktsegment
        FROM customer WHERE NULLIF(c_mktsegment, 'BUILDING') IS NULL""",
    "typed_casts": f"""
        SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS KEY_STR,
               CAST(trunc(o_totalprice) AS INTEGER) AS PRICE_INT,
               {_half_up('o_totalprice')} AS PRICE_DEC,
               CASE WHEN o_orderpriority = '1-URGENT' THEN NULL
                    ELSE CAST(o_orderdate AS DATE) END AS ORDER_DATE,
               CAST(o_orderdate AS DATE) AS ORDER_DATE_ANY
        FROM orders""",
    "quality_completeness": _labelled(["teste_completude_nome", "teste_completude_nacao"]),
    "quality_range": _labelled(["teste_range_saldo"]),
    "quality_sign": _labelled(["teste_saldo", "teste_nacao"]),
    "quality_labels": _labelled(_ALL),
    "quality_gate": f"""
        SELECT FONTE, ENTITY_KEY, NAME, NATION_KEY, BALANCE FROM ({_labelled(_ALL)}) l
        WHERE {' AND '.join(f"{n} = 'correto'" for n in _ALL)}""",
    "quality_report": f"WITH l AS ({_labelled(_ALL)}) {_REPORT}",
    "derived_ratio": f"""
        SELECT l_orderkey, l_linenumber, l_tax, l_discount, {_RATIO} AS RATIO
        FROM lineitem""",
    "quality_ratio_check": f"""
        SELECT l_orderkey, l_linenumber, RATIO, REPORTED,
               RATIO = CAST(REPORTED AS DOUBLE) AS RATIO_OK
        FROM (SELECT l_orderkey, l_linenumber, RATIO, {_half_up('RATIO')} AS REPORTED
              FROM (SELECT l_orderkey, l_linenumber, {_RATIO} AS RATIO FROM lineitem) r) q""",
    "lag_value": """
        SELECT event_id, user_id, ts, value,
               LAG(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS PREV_VALUE
        FROM events""",
    "lag_hot_key": _LAG_BY_TYPE,
    "lag_bucketed": _LAG_BY_TYPE,
    "lag_hot_bucket": """
        SELECT event_id, 'all' AS SERIES, DATE '2024-01-01' AS DAY,
               'common-prefix-of-all-' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS LABEL, value,
               LAG(value) OVER (ORDER BY event_id) AS PREV_VALUE
        FROM events""",
    "lag_by_number": """
        SELECT event_id, event_type, value,
               LAG(value) OVER (PARTITION BY event_type ORDER BY event_id) AS PREV_VALUE
        FROM events""",
    "daily_with_ties": """
        WITH r AS (
          SELECT o_custkey, CAST(o_orderdate AS DATE) AS DATE_ID, o_orderstatus AS FONTE,
                 l_quantity AS q, l_extendedprice AS p
          FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
        d AS (
          SELECT *, LAG(q) OVER w AS pq, LAG(p) OVER w AS pp
          FROM r WINDOW w AS (PARTITION BY o_custkey ORDER BY DATE_ID, FONTE, q, p))
        SELECT o_custkey, DATE_ID, FONTE, q AS QUANTITY_AC, p AS PRICE_AC,
               COALESCE(q - pq, q) AS QUANTITY, COALESCE(p - pp, p) AS PRICE,
               COUNT(*) AS FIRST, COUNT(*) AS SECOND
        FROM d GROUP BY ALL""",
    "title_links": """
        WITH n AS (SELECT page_id, 'page-' || regexp_replace(url, '[^A-Za-z0-9]+', '-', 'g') AS k FROM pages),
        t AS (SELECT page_id, k AS plain, CASE page_id % 7 WHEN 4 THEN 'a &amp; b-' || k || ' <1>' WHEN 5 THEN k || '-b' ELSE k END AS k FROM n)
        SELECT page_id, k || '.csv' AS Cam_Git, k AS DATE_KEY, 'General' AS Tipo FROM t WHERE page_id % 7 <> 3
        UNION ALL
        SELECT page_id, plain || '.CSV', plain, 'US' FROM t WHERE page_id % 7 = 0""",
    "incremental_ingest": """
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
               o_orderstatus, o_orderpriority,
               'o=' || replace(strftime(o_orderdate, '%Y-%m'), '-', ' 50%+') AS DATE_KEY
        FROM orders""",
    "csv_text_roundtrip": """
        SELECT 'd' AS T, doc_id AS ID, text AS TEXT FROM documents
        UNION ALL SELECT 'c', conv_id * 1000 + turn, text FROM conversations
        UNION ALL SELECT 'r', r_regionkey, CASE r_regionkey WHEN 0 THEN '' WHEN 1 THEN '  two blanks  '
          WHEN 2 THEN '"a" ' || chr(92) || ' ' || chr(92) || '"b|,' || chr(10) || chr(13) || chr(10) WHEN 3 THEN NULL ELSE ' ' END
        FROM region""",
    "csv_timestamp_roundtrip": "SELECT * FROM events",
    "publish_star": """
        WITH l AS (
          SELECT c.c_custkey, NULLIF(r.r_name, 'AMERICA') AS STATE, NULLIF(n.n_name, 'NATION_7') AS COUNTRY
          FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
        f AS (
          SELECT COALESCE(STATE, '') || COUNTRY AS LOCATION_KEY, COUNTRY,
                 CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS DATE_ID, o_custkey
          FROM orders JOIN l ON o_custkey = c_custkey)
        SELECT LOCATION_KEY, DATE_ID, COUNT(*) AS N, CAST(SUM(o_custkey) AS BIGINT) AS CONFIRMED, COUNTRY AS PAIS,
               1 AS KNOWN_DATE, (SELECT COUNT(*) FROM f) AS BASE_ROWS
        FROM f GROUP BY LOCATION_KEY, DATE_ID, COUNTRY""",
    "cumulative_to_daily": f"""
        SELECT o_custkey, DATE_ID, o_orderkey, TOTALPRICE AS TOTALPRICE_AC,
               COALESCE(TOTALPRICE - LAG(TOTALPRICE) OVER ({_W_CUST}), TOTALPRICE) AS TOTALPRICE
        FROM ({_SNAP.format(total='o_totalprice')}) s""",
    "cumulative_to_daily_gaps": f"""
        SELECT o_custkey, DATE_ID, o_orderkey, TOTALPRICE AS TOTALPRICE_AC,
               COALESCE(TOTALPRICE - LAG(TOTALPRICE) OVER ({_W_CUST}), TOTALPRICE) AS TOTALPRICE
        FROM ({_SNAP.format(total=_GAP_TOTAL)}) s""",
    "cumulative_to_daily_skip_gaps": f"""
        SELECT o_custkey, DATE_ID, o_orderkey, TOTALPRICE AS TOTALPRICE_AC,
               COALESCE(TOTALPRICE - LAST_VALUE(TOTALPRICE IGNORE NULLS) OVER (
                   {_W_CUST} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                   TOTALPRICE) AS TOTALPRICE
        FROM ({_SNAP.format(total=_GAP_TOTAL)}) s""",
    "location_dim": """
        WITH rows AS (
          SELECT c.c_custkey, NULLIF(r.r_name, 'AMERICA') AS STATE,
                 NULLIF(n.n_name, 'NATION_7') AS COUNTRY
          FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
                          JOIN region r ON n.n_regionkey = r.r_regionkey),
        keyed AS (SELECT *, COALESCE(STATE, '') || COUNTRY AS LOCATION_KEY FROM rows)
        SELECT LOCATION_KEY, COUNTRY, STATE, c_custkey AS FIRST_CUSTKEY
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY LOCATION_KEY ORDER BY c_custkey) AS rn
              FROM keyed) k
        WHERE rn = 1""",
    "calendar_dim": """
        SELECT DATE_ID,
               CAST(year(DATE_ID) AS INTEGER) AS "Ano",
               monthname(DATE_ID) AS "Nome do Mês",
               CAST(month(DATE_ID) AS INTEGER) AS "Mês",
               CAST(quarter(DATE_ID) AS INTEGER) AS "Trimestre",
               CAST(weekofyear(DATE_ID) AS INTEGER) AS "Semana do Ano",
               dayname(DATE_ID) AS "Nome do Dia",
               CAST(dayofweek(DATE_ID) + 1 AS INTEGER) AS "Dia da Semana"
        FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS DATE_ID FROM orders) d""",
    "fact_projection": """
        SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS DATE_ID,
               o_orderstatus AS FONTE, o_totalprice AS TOTALPRICE,
               CAST(o_orderdate AS DATE) AS DATE_KEY_PART
        FROM orders""",
    "star_fact": """
        WITH base AS (
          SELECT r.r_name AS STATE, n.n_name AS COUNTRY, CAST(o.o_orderdate AS DATE) AS DATE_ID,
                 o.o_orderstatus AS FONTE, o.o_orderkey, o.o_totalprice AS TOTALPRICE
          FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
                        JOIN nation n ON c.c_nationkey = n.n_nationkey
                        JOIN region r ON n.n_regionkey = r.r_regionkey)
        SELECT COALESCE(STATE, '') || COUNTRY AS LOCATION_KEY, DATE_ID, FONTE, o_orderkey,
               COALESCE(TOTALPRICE - LAG(TOTALPRICE) OVER (
                   PARTITION BY STATE, COUNTRY ORDER BY DATE_ID, FONTE, o_orderkey),
                   TOTALPRICE) AS TOTALPRICE,
               TOTALPRICE AS TOTALPRICE_AC, DATE_ID AS DATE_KEY_PART
        FROM base""",
    "sql_null_date": """
        SELECT o_orderkey, o_custkey, NULL::DATE AS DATE_ID, o_orderstatus AS FONTE,
               o_totalprice AS TOTALPRICE
        FROM orders WHERE o_orderstatus = 'P'""",
    "missing_keys": _MISSING_ORDERS,
    "missing_keys_empty_target": "SELECT o_orderkey FROM orders",
    "left_join_keys": """
        SELECT o.o_orderkey, o.o_orderstatus, l.Cam_Lake
        FROM orders o LEFT JOIN (SELECT DISTINCT l_orderkey, 'lineitem' AS Cam_Lake
                                 FROM lineitem) l ON o.o_orderkey = l.l_orderkey""",
    "listing_scan": """
        SELECT strftime(o_orderdate, '%Y-%m') AS "DATE_KEY", count(*) AS "N", sum(o_orderkey)::BIGINT AS "ORDERS",
               count(DISTINCT o_custkey) AS "CUSTOMERS"
        FROM orders WHERE (year(o_orderdate) * 12 + month(o_orderdate)) % 10 = 0 GROUP BY 1""",
    "incremental_load": """
        SELECT d.* FROM documents d
        WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "pending_count": f"""
        SELECT COUNT(*) AS PENDING
        FROM ({_MISSING_ORDERS} UNION ALL {_MISSING_DOCS}) p""",
    "page_links": """
        SELECT page_id, link AS Cam_Git,
               regexp_replace(link, '(?i)\\.csv$', '') AS DATE_KEY, 'pages' AS Tipo
        FROM (SELECT page_id,
                     unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS link
              FROM pages) p""",
    "file_listing_keys": """
        SELECT DISTINCT strftime(o_orderdate, '%m-%Y') || '.csv' AS Cam_Lake, strftime(o_orderdate, '%m-%Y') AS DATE_KEY,
               'raw/' || strftime(o_orderdate, '%m-%Y') || '.csv' AS SOURCE_URL
        FROM orders""",
    "partition_listing_keys": """
        SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS DATE_KEY FROM orders""",
    "csv_scan_strings": _ORDERS_TEXT,
    "csv_scan_inferred": _ORDERS_TEXT,
    "csv_scan_typed": "SELECT * FROM orders",
    "csv_roundtrip": "SELECT * FROM part",
    "csv_single_file_roundtrip": _MISSING_ORDERS,
    "csv_partitioned_scan": "SELECT * FROM orders WHERE o_orderstatus = 'F'",
    "csv_transcode": "SELECT * FROM supplier",
}
