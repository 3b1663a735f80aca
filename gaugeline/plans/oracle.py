"""The same queries as plain SQL, for checking results in another engine."""

from __future__ import annotations

from gaugeline import fixed_values as fv

ORACLE: dict[str, str] = {}


def sql(name: str, body: str, *ctes: str) -> None:
    ORACLE[name] = ("WITH RECURSIVE " + ",\n".join(ctes) + "\n" if ctes else "") + body.strip()


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def texts(values) -> str:
    return "[" + ", ".join(text(v) for v in values) + "]"


WS = fv.WHITESPACE_CLASS
STRIP_CHARS = " || ".join(f"chr({ord(c)})" for c in fv.WHITESPACE)


def strip(expr: str) -> str:
    return f"trim({expr}, {STRIP_CHARS})"


# --- Observations from orders -----------------------------------------------

BRONZE = """bronze AS (
  SELECT CASE WHEN o_orderstatus = 'O' THEN ' ' || lower(n_name) || ' ' ELSE n_name END AS country_code,
         ' ' || n_name AS country_name, o_orderpriority AS indicator_code,
         'Orders ' || o_orderpriority AS indicator_name, CAST(year(o_orderdate) AS BIGINT) AS year,
         CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS value, o_orderdate AS _ingested_at, o_orderkey AS obs_id
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def silver(keys: str) -> str:
    return f"""silver AS (
  SELECT country_code, country_name, indicator_code, indicator_name, year, value, ingested_at FROM (
    SELECT upper(trim(b.country_code)) AS country_code, trim(b.country_name) AS country_name,
           trim(b.indicator_code) AS indicator_code, trim(b.indicator_name) AS indicator_name,
           CAST(b.year AS INTEGER) AS year, b.value, b._ingested_at AS ingested_at,
           row_number() OVER (PARTITION BY {keys}, b.year ORDER BY b._ingested_at DESC, b.obs_id DESC) AS rn
    FROM bronze b WHERE b.value IS NOT NULL) WHERE rn = 1)"""


SILVER = silver("upper(trim(b.country_code)), trim(b.indicator_code)")

COUNTRY_SEED = """country_seed AS (
  SELECT n_name AS country_code, CASE WHEN r_name <> 'ASIA' THEN n_name END AS country_name, r_name AS region,
         CASE n_nationkey % 3 WHEN 0 THEN 'High income' WHEN 1 THEN 'Upper-middle income'
              ELSE 'Lower-middle income' END AS income_group,
         r_name = 'ASIA' AS is_asean, n_nationkey = 0 AS is_primary
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

COUNTRIES = """dim_countries AS (
  SELECT row_number() OVER (ORDER BY s.country_code) AS country_key, s.country_code,
         coalesce(s.country_name, w.country_name) AS country_name, region, income_group, is_asean, is_primary
  FROM country_seed s LEFT JOIN (SELECT DISTINCT country_code, country_name FROM silver) w
    ON s.country_code = w.country_code)"""

INDICATORS = """dim_indicators AS (
  SELECT row_number() OVER (ORDER BY code) AS indicator_key, code AS indicator_code, 'Orders ' || code AS indicator_name,
         'world_bank' AS source_system,
         CASE WHEN code IN ('1-URGENT', '2-HIGH') THEN 'trade' ELSE 'structure' END AS category,
         'USD' AS unit, 'annual' AS frequency,
         CASE WHEN code = '5-LOW' THEN '' ELSE 'Total price of orders with priority ' || code END AS description
  FROM (SELECT DISTINCT o_orderpriority AS code FROM orders))"""


def calendar(source: str, day: str) -> str:
    return f"""dim_dates AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
         extract(year FROM d) AS year, extract(quarter FROM d) AS quarter, extract(month FROM d) AS month,
         monthname(d) AS month_name, extract(dow FROM d) + 1 AS day_of_week,
         extract(dow FROM d) IN (0, 6) AS is_weekend, false AS is_vietnam_holiday, extract(year FROM d) AS fiscal_year_vn
  FROM (SELECT unnest(generate_series(make_date(lo, 1, 1), make_date(hi, 12, 31), INTERVAL 1 DAY)) AS d
        FROM (SELECT min(year({day})) AS lo, max(year({day})) AS hi FROM {source})))"""


FACT = """fact AS (
  SELECT indicator_key, country_key, date_key, make_date(s.year, 1, 1) AS period_start,
         make_date(s.year, 12, 31) AS period_end, value, 'world_bank' AS source_system, ingested_at AS loaded_at
  FROM silver s JOIN dim_countries c ON s.country_code = c.country_code
  JOIN dim_indicators i ON s.indicator_code = i.indicator_code AND i.source_system = 'world_bank'
  JOIN dim_dates d ON d.full_date = make_date(s.year, 1, 1))"""

ORDER_SILVER = [BRONZE, SILVER]
ORDER_GOLD = [BRONZE, SILVER, COUNTRY_SEED, COUNTRIES, INDICATORS, calendar("orders", "o_orderdate"), FACT]

TRADE_GOLD = [
    """bronze AS (
  SELECT n_name AS country_code, n_name AS country_name, 'P' || l_partkey AS indicator_code,
         'P' || l_partkey AS indicator_name, CAST(year(l_shipdate) AS BIGINT) AS year, l_extendedprice AS value,
         l_shipdate AS _ingested_at, l_orderkey, l_linenumber
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)""",
    """silver AS (
  SELECT country_code, country_name, indicator_code, indicator_name, CAST(year AS INTEGER) AS year, value,
         _ingested_at AS ingested_at
  FROM (SELECT *, row_number() OVER (PARTITION BY country_code, indicator_code, year
          ORDER BY _ingested_at DESC, l_orderkey DESC, l_linenumber DESC, value DESC) AS rn FROM bronze) WHERE rn = 1)""",
    COUNTRY_SEED,
    COUNTRIES,
    """part_seed AS (
  SELECT 'P' || p_partkey AS indicator_code, p_name AS indicator_name, lower(p_type) AS category, 'USD' AS unit,
         'annual' AS frequency, p_brand || ' ' || p_name || ' size ' || p_size AS description FROM part)""",
    """dim_indicators AS (
  SELECT row_number() OVER (ORDER BY indicator_code) AS indicator_key, indicator_code, indicator_name,
         'world_bank' AS source_system, category, unit, frequency, description FROM part_seed)""",
    calendar("lineitem", "l_shipdate"),
    FACT,
]
PART_SEED = TRADE_GOLD[4]

SILVER_COLUMNS = "country_code, country_name, indicator_code, indicator_name, year, value, ingested_at"
sql("silver_dedup", f"SELECT {SILVER_COLUMNS} FROM silver", *ORDER_SILVER)
sql("silver_dedup_raw_keys", f"SELECT {SILVER_COLUMNS} FROM silver", BRONZE,
    silver("b.country_code, b.indicator_code"))
sql("dim_countries", "SELECT * FROM dim_countries", *ORDER_GOLD)
sql("dim_indicators", "SELECT * FROM dim_indicators", *ORDER_GOLD)
sql("dim_dates", "SELECT * FROM dim_dates ORDER BY full_date", calendar("orders", "o_orderdate"))
ORACLE["calendar_sql"] = ORACLE["dim_dates"].removesuffix(" ORDER BY full_date")
sql("fact_load", "SELECT * FROM fact", *ORDER_GOLD)
sql("fact_load_trade", "SELECT * FROM fact", *TRADE_GOLD)

CATALOGUE_DOCS = """docs AS (
  SELECT CAST(doc_id AS VARCHAR) AS doc_id,
         split_part(text, chr(10), 1) || coalesce(' - ' || p_name, '') AS title, text AS abstract, '' AS display_date,
         source AS doc_type, 'http://docs.example.org/pdf/' || doc_id || '.pdf' AS pdf_url,
         'NATION_' || (doc_id % 25) || '; nation_' || ((doc_id * 7 + 3) % 25) || ';NATION_' || ((doc_id * 3 + 1) % 25) AS countries,
         t[1 + doc_id % 6] || ';' || t[1 + (doc_id // 6) % 6] AS topics, lang AS language
  FROM documents LEFT JOIN part ON p_partkey = doc_id,
       (SELECT ['economy', 'small', 'medium', 'promo', 'standard', 'large'] AS t))"""
sql("silver_documents", """
SELECT doc_id, trim('  ' || title || ' ') AS title, trim(abstract) AS abstract, display_date, doc_type, pdf_url,
       trim(countries) AS countries, topics, language, 'world_bank_docs' AS source FROM docs""", CATALOGUE_DOCS)
sql("silver_chunks", """
SELECT conv_id || '-' || turn AS chunk_id, turn AS chunk_index, text, CAST(conv_id AS VARCHAR) AS doc_id, role AS source
FROM conversations WHERE turn <> 1 AND length(text) > 0""")

# --- Serving -------------------------------------------------------------------

STAR = """star AS (
  SELECT i.indicator_code, i.indicator_name, c.country_code, c.country_name, d.year, d.full_date, f.value, i.category,
         f.source_system
  FROM fact f JOIN dim_indicators i ON f.indicator_key = i.indicator_key
  JOIN dim_countries c ON f.country_key = c.country_key JOIN dim_dates d ON f.date_key = d.date_key)"""
SERVED = "SELECT indicator_code, indicator_name, country_code, year, value, category, source_system FROM star"
NAMED = """named AS (
  SELECT c.country_code, c.country_name, i.indicator_code, i.indicator_name, i.unit,
         CAST(extract(year FROM f.period_start) AS INTEGER) AS year, f.period_start, f.value
  FROM fact f JOIN dim_countries c ON f.country_key = c.country_key
  JOIN dim_indicators i ON f.indicator_key = i.indicator_key)"""
LATEST = """latest AS (
  SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY country_code, indicator_code
    ORDER BY period_start DESC, value DESC) AS rn FROM named) WHERE rn = 1)"""

sql("catalogue_countries", "SELECT country_code, country_name, region, income_group FROM dim_countries ORDER BY country_name", *ORDER_GOLD)
sql("catalogue_indicators", "SELECT indicator_code, indicator_name, category, unit, description FROM dim_indicators ORDER BY indicator_name", *TRADE_GOLD)
sql("country_lookup", "SELECT * FROM dim_countries WHERE country_code = 'NATION_7'", *ORDER_GOLD)
sql("indicators_by_country", f"{SERVED} WHERE country_code = 'NATION_3' AND year BETWEEN 1996 AND 2000 ORDER BY indicator_code, year DESC", *ORDER_GOLD, STAR)
sql("indicators_open_range", f"{SERVED} WHERE country_code = 'NATION_3'", *TRADE_GOLD, STAR)
sql("indicators_filtered", f"{SERVED} WHERE indicator_code IN ('1-URGENT', '5-LOW') AND category = 'trade' AND source_system = 'world_bank'", *ORDER_GOLD, STAR)
sql("indicator_series", f"{SERVED} WHERE indicator_code = '1-URGENT'", *ORDER_GOLD, STAR)
sql("indicator_series_country", f"{SERVED} WHERE indicator_code = '3-MEDIUM' AND country_code = 'NATION_12'", *ORDER_GOLD, STAR)
sql("series_by_name", "SELECT country_name, indicator_name, full_date, value FROM star WHERE country_name = 'NATION_4' AND indicator_name = 'Orders 2-HIGH' ORDER BY full_date", *ORDER_GOLD, STAR)
sql("fact_latest", "SELECT * FROM latest", *TRADE_GOLD, NAMED, LATEST)
ONE = "SELECT * FROM named WHERE country_code = 'NATION_9' AND indicator_code = '1-URGENT'"
sql("fact_for_year", f"{ONE} AND year = 1998 LIMIT 1", *ORDER_GOLD, NAMED)
sql("fact_newest", f"{ONE} ORDER BY period_start DESC LIMIT 1", *ORDER_GOLD, NAMED)
sql("fact_timeseries", f"{ONE} ORDER BY period_start", *ORDER_GOLD, NAMED)
sql("paged_indicators", """
SELECT indicator_code, indicator_name, country_code, year, value, category, source_system, count(*) OVER () AS total
FROM star ORDER BY indicator_code, country_code, year DESC LIMIT 50 OFFSET 100""", *ORDER_GOLD, STAR)
sql("stored_pages", """
SELECT indicator_code, indicator_name, country_code, year, value, category, source_system, page FROM (
  SELECT *, row_number() OVER (ORDER BY indicator_code, country_code, year DESC) AS place, count(*) OVER () AS total FROM star)
JOIN (VALUES ('last'), ('fourth')) t(page)
  ON (page = 'last' AND place > 50 * (greatest(total // 50, 1) - 1) AND place <= 50 * greatest(total // 50, 1))
  OR (page = 'fourth' AND place > 150 AND place <= 200)""", *ORDER_GOLD, STAR)

TWO_SOURCES = """observed AS (
  SELECT country_code, indicator_code, year, value, 'world_bank' AS source_system FROM silver
  UNION ALL
  SELECT country_code, indicator_code, year, value * (CAST(1.03 AS DOUBLE) + (year % 3) * CAST(0.03 AS DOUBLE)),
         CASE WHEN country_code = 'NATION_1' THEN 'office_1' ELSE 'office_2' END
  FROM silver WHERE indicator_code = '2-HIGH')"""
sql("conflict_view", """
SELECT * REPLACE (round(difference, 9) AS difference) FROM (
  SELECT a.country_code, a.indicator_code, a.year, a.source_system AS source_a, a.value AS value_a,
         b.source_system AS source_b, b.value AS value_b,
         abs(a.value - b.value) / greatest(abs(a.value), abs(b.value)) AS difference
  FROM observed a JOIN observed b ON a.country_code = b.country_code AND a.indicator_code = b.indicator_code
    AND a.year = b.year AND a.source_system < b.source_system) WHERE difference > 0.05""", *ORDER_SILVER, TWO_SOURCES)
sql("authoritative_source", """
SELECT country_code, indicator_code, year, value, source_system FROM (
  SELECT *, row_number() OVER (PARTITION BY country_code, indicator_code, year ORDER BY
    CASE WHEN (source_system = 'office_1' AND country_code = 'NATION_1')
           OR (source_system = 'office_2' AND country_code = 'NATION_2') THEN 0
         WHEN source_system = 'world_bank' THEN 1 ELSE 2 END, source_system) AS rn
  FROM observed) WHERE rn = 1""", *ORDER_SILVER, TWO_SOURCES)
sql("multi_source_grains", """
SELECT 'annual' AS grain, CAST(date_trunc('year', o_orderdate) AS DATE) AS period_start, count(*) AS n_orders
FROM orders GROUP BY ALL
UNION ALL
SELECT 'monthly', CAST(date_trunc('month', o_orderdate) AS DATE), count(*) FROM orders GROUP BY ALL""")
sql("load_years", """
SELECT CASE WHEN month(o_orderdate) < 7 THEN year(o_orderdate) - 1 ELSE year(o_orderdate) END AS load_year,
       month(o_orderdate) IN (3, 6, 9, 12) AS quarter_end, count(*) AS n_orders FROM orders GROUP BY ALL""")

# --- Quality ---------------------------------------------------------------------


def not_null(table: str, label: str, columns: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT 'not_null:{label}.{c}' AS \"check\", count(*) FILTER (WHERE {c} IS NULL) AS violations FROM {table}"
        for c in columns)


def counted(name: str, body: str) -> str:
    return f"SELECT '{name}', (SELECT count(*) FROM ({body}))"


def repeated(table: str, key: str) -> str:
    return f"SELECT {key} FROM {table} WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1"


def odd_values(table: str, column: str, values: str) -> str:
    return f"SELECT {column} FROM {table} WHERE {column} NOT IN ({values}) GROUP BY {column}"


def orphaned(key: str, parent: str) -> str:
    return f"SELECT 1 FROM fact WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {key} FROM {parent})"


sql("dq_not_null", not_null("bronze", "observations", ["country_code", "indicator_code", "year", "value"]), BRONZE)
sql("dq_unique", """
SELECT country_code, indicator_code, year, count(*) AS n_rows FROM bronze GROUP BY ALL HAVING count(*) > 1""", BRONZE)
sql("dq_accepted", "SELECT o_orderstatus, count(*) AS n_rows FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY ALL")
sql("dq_relationships", """
SELECT l_suppkey, count(*) AS n_rows FROM lineitem
WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY l_suppkey""")
sql("dq_positive", """
SELECT c_custkey, c_mktsegment, c_acctbal FROM customer
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') AND c_acctbal <= 0""")
sql("dq_future", """
SELECT f.*, d.full_date FROM fact f JOIN dim_dates d ON f.date_key = d.date_key
WHERE d.full_date > DATE '2000-06-30'""", *ORDER_GOLD)
sql("dq_suite", "\nUNION ALL\n".join([
    not_null("dim_countries", "dim_countries", ["country_key", "country_code"]),
    not_null("dim_indicators", "dim_indicators", ["indicator_key", "indicator_code"]),
    not_null("dim_dates", "dim_dates", ["date_key", "full_date"]),
    not_null("fact", "fact", ["indicator_key", "country_key", "date_key", "value"]),
    counted("unique:dim_countries.country_key", repeated("dim_countries", "country_key")),
    counted("unique:dim_countries.country_code", repeated("dim_countries", "country_code")),
    counted("unique:dim_indicators.indicator_key", repeated("dim_indicators", "indicator_key")),
    counted("unique:dim_dates.date_key", repeated("dim_dates", "date_key")),
    counted("unique:dim_dates.full_date", repeated("dim_dates", "full_date")),
    counted("accepted:dim_countries.is_asean", odd_values("dim_countries", "is_asean", "true, false")),
    counted("accepted:dim_countries.is_primary", odd_values("dim_countries", "is_primary", "true, false")),
    counted("accepted:dim_indicators.category", odd_values("dim_indicators", "category", ", ".join(map(text, fv.CATEGORIES)))),
    counted("accepted:dim_indicators.frequency", odd_values("dim_indicators", "frequency", ", ".join(map(text, fv.FREQUENCIES)))),
    counted("relationship:fact.indicator_key", orphaned("indicator_key", "dim_indicators")),
    counted("relationship:fact.country_key", orphaned("country_key", "dim_countries")),
    counted("relationship:fact.date_key", orphaned("date_key", "dim_dates")),
    counted("gdp_positive", """SELECT 1 FROM fact WHERE value <= 0 AND indicator_key IN
        (SELECT indicator_key FROM dim_indicators WHERE indicator_code IN ('1-URGENT', '2-HIGH'))"""),
    counted("no_future_dates", "SELECT 1 FROM fact f JOIN dim_dates d ON f.date_key = d.date_key WHERE full_date > DATE '2000-06-30'"),
    not_null("silver", "observations", ["country_code", "indicator_code", "year", "value"]),
]), *ORDER_GOLD)
sql("dq_ranges", """
SELECT country_code, year, value FROM named
WHERE indicator_code = '3-MEDIUM' AND (value < 100000 OR value > 400000)""", *ORDER_GOLD, NAMED)

sql("dq_named_ranges", """
SELECT 'range:1-URGENT' AS "check", count(*) AS violations FROM named
WHERE indicator_code = '1-URGENT' AND (value < 50000 OR value > 300000)
UNION ALL SELECT 'range:2-HIGH', count(*) FROM named WHERE indicator_code = '2-HIGH' AND value < 1000
UNION ALL SELECT 'range:3-MEDIUM', count(*) FROM named
WHERE indicator_code = '3-MEDIUM' AND (value < 100000 OR value > 400000)""", *ORDER_GOLD, NAMED)
sql("seed_csv", "SELECT n_nationkey, n_name, n_regionkey FROM nation")

# --- Sinks and verification ----------------------------------------------------------

sql("publish_counts", """
SELECT 'dim_countries' AS table_name, count(*) AS n_rows FROM dim_countries
UNION ALL SELECT 'dim_indicators', count(*) FROM dim_indicators
UNION ALL SELECT 'dim_dates', count(*) FROM dim_dates
UNION ALL SELECT 'fact_economic_indicators', count(*) FROM fact""", *ORDER_GOLD)
sql("layer_reconciliation", """
SELECT table_name, source_rows, target_rows, source_rows - target_rows AS difference FROM (
  SELECT 'observations' AS table_name, (SELECT count(*) FROM bronze WHERE value IS NOT NULL) AS source_rows,
         (SELECT count(*) FROM silver) AS target_rows
  UNION ALL SELECT 'facts', (SELECT count(*) FROM silver), (SELECT count(*) FROM fact)
  UNION ALL SELECT 'countries', (SELECT count(*) FROM nation), (SELECT count(*) FROM dim_countries))""", *ORDER_GOLD)
sql("bronze_profile", """
SELECT count(*) AS n_rows, min(year) AS first_year, max(year) AS last_year,
       count(DISTINCT indicator_code) AS n_indicators, count(DISTINCT country_code) AS n_countries FROM bronze""", BRONZE)
sql("partition_summary", """
SELECT year, count(*) AS n_rows, count(DISTINCT indicator_code) AS n_indicators FROM bronze GROUP BY year""", BRONZE)
sql("stored_files", "SELECT year, count(*) AS n_rows FROM bronze GROUP BY year", BRONZE)
sql("layered_build", """
SELECT region, count(*) AS n, count(DISTINCT country_code) AS n_countries, CAST(max(year) AS BIGINT) AS last_year
FROM silver JOIN country_seed USING (country_code) GROUP BY region""", *ORDER_SILVER, COUNTRY_SEED)
sql("publish_gate", """
SELECT attempt, table_name, check_name, n_rows, n_failing, version FROM (
  SELECT 1 AS attempt, 'dim_countries' AS table_name, 'country_code_not_null' AS check_name, (SELECT count(*) FROM dim_countries) AS n_rows,
         0 AS n_failing, 1 AS version
  UNION ALL SELECT 1, 'dim_indicators', NULL, (SELECT count(*) FROM dim_indicators), 0, 1
  UNION ALL SELECT 1, 'dim_dates', NULL, (SELECT count(*) FROM dim_dates), 0, 1
  UNION ALL SELECT 1, 'fact_economic_indicators', c, (SELECT count(*) FROM fact), 0, 1
    FROM (VALUES ('value_not_null'), ('country_key_not_null'), ('value_within')) t(c)
  UNION ALL SELECT 2, 'dim_countries', 'country_code_not_null', 1, 0, NULL
  UNION ALL SELECT 2, 'fact_economic_indicators', c, (SELECT count(*) FROM fact),
    CASE WHEN c = 'value_not_null' THEN (SELECT count(*) FROM fact WHERE year(period_start) = 1995) ELSE 0 END, NULL
    FROM (VALUES ('value_not_null'), ('country_key_not_null'), ('value_within')) t(c)
  UNION ALL SELECT 3, 'dim_countries', 'published', (SELECT count(*) FROM dim_countries), 0, NULL
  UNION ALL SELECT 3, 'dim_indicators', 'published', (SELECT count(*) FROM dim_indicators), 0, NULL
  UNION ALL SELECT 3, 'dim_dates', 'published', (SELECT count(*) FROM dim_dates), 0, NULL
  UNION ALL SELECT 3, 'fact_economic_indicators', 'published', (SELECT count(*) FROM fact), 0, NULL)""", *ORDER_GOLD)

sql("search_rows_upsert", """
SELECT indicator_code, indicator_name, category,
       CASE WHEN category = 'large' THEN 're-described' ELSE description END AS description FROM part_seed""", PART_SEED)
sql("document_search_rows", """
SELECT doc_id, title, CASE WHEN doc_type = 'src3' THEN '' ELSE doc_type END AS doc_type, abstract, topics, countries
FROM docs""", CATALOGUE_DOCS)

# --- Landed API responses ---------------------------------------------------------------

sql("normalise_observations", """
SELECT 'N' || c_nationkey AS country_code,
       CASE WHEN c_nationkey % 2 = 0 THEN coalesce(n_name, 'N' || c_nationkey) ELSE 'N' || c_nationkey END AS country_name,
       o_orderpriority AS indicator_code,
       CASE WHEN o_orderpriority <> '5-LOW' THEN 'Orders ' || o_orderpriority ELSE o_orderpriority END AS indicator_name,
       CAST(year(o_orderdate) AS BIGINT) AS year, o_totalprice AS value, 'world_bank' AS _source
FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderstatus <> 'P' AND o_totalprice IS NOT NULL""")


def collapse(expr: str) -> str:
    return f"trim(regexp_replace({expr}, '{WS}+', ' ', 'g'))"


sql("normalise_documents", f"""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, 'Report no. ' || doc_id AS title,
       CASE WHEN length(text) > 10 THEN {collapse('text')} ELSE '' END AS abstract,
       CASE WHEN lang = 'en' THEN '2024-01-01' ELSE '2023-12-31' END AS display_date, source AS doc_type, '' AS pdf_url,
       lang || ';' || source AS countries, 'Trade Policy' AS topics, lang AS language, 'world_bank_docs' AS _source
FROM documents""")
sql("search_result_cap", """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, 'Report no. ' || doc_id AS title, lang || ';' || source AS countries
FROM documents ORDER BY documents.doc_id LIMIT 500""")

ORACLE["landed_source"] = ORACLE["normalise_documents"] + " WHERE lang = 'en'"
ORACLE["landed_stream"] = ORACLE["normalise_documents"]

# --- Text -----------------------------------------------------------------------------------

sql("doc_clean", f"SELECT doc_id, {collapse('text')} AS cleaned, length({collapse('text')}) AS n_chars FROM documents")
sql("text_url_rewrite", """
SELECT page_id, CASE WHEN page_id % 2 = 0 THEN replace(replace(url || '/pdf/' || page_id, 'http://', 'https://'), '/pdf/', '/text/') || '.txt' END AS text_url
FROM pages""")


def split_sentences(expr: str) -> str:
    return f"regexp_split_to_array(regexp_replace({expr}, '([.!?]){WS}+', '\\1' || chr(1), 'g'), '[\\x{{01}}\\n]')"


def sliced(expr: str, width: int) -> str:
    return f"list_transform(generate_series(0, (length({expr}) - 1) // {width}), lambda i: substr({expr}, CAST(i * {width} + 1 AS BIGINT), {width}))"


def chunk_ctes(source: str, key: str, size: int, overlap: int) -> list[str]:
    breaks = fv.PARAGRAPH_BREAK
    return [
        f"""paragraphs AS (
  SELECT {key}, row_number() OVER () AS p, {strip('part')} AS part FROM (
    SELECT {key}, unnest(regexp_split_to_array(text, '{breaks}')) AS part FROM {source}))""",
        f"""pieces AS (
  SELECT {key}, list(piece ORDER BY p, s, n) AS pieces FROM (
    SELECT {key}, p, s, unnest(range(len(cut))) AS n, unnest(cut) AS piece FROM (
      SELECT {key}, p, s, CASE WHEN length(sentence) <= {size} THEN [sentence] ELSE {sliced('sentence', size)} END AS cut FROM (
        SELECT {key}, p, unnest(range(len(found))) AS s, unnest(found) AS sentence FROM (
          SELECT {key}, p, CASE WHEN length(part) <= {size} THEN [part] ELSE
            list_filter(list_transform({split_sentences('part')}, lambda x: {strip('x')}), lambda x: x <> '') END AS found
          FROM paragraphs WHERE part <> ''))))
  GROUP BY {key})""",
        f"""packed AS (
  SELECT {key}, list_reduce(list_transform(pieces, lambda x: {{'closed': []::VARCHAR[], 'open': x}}), lambda a, x:
    CASE WHEN length(a.open) + 2 + length(x.open) <= {size}
         THEN {{'closed': a.closed, 'open': a.open || chr(10) || chr(10) || x.open}}
         WHEN length(a.open) > {overlap} AND length(x.open) + 2 + {overlap} <= {size}
         THEN {{'closed': list_append(a.closed, a.open), 'open': right(a.open, {overlap}) || chr(10) || chr(10) || x.open}}
         ELSE {{'closed': list_append(a.closed, a.open), 'open': x.open}} END) AS r FROM pieces)""",
        f"""chunk_texts AS (
  SELECT {key}, unnest(range(len(c))) AS chunk_index, unnest(c) AS text FROM (
    SELECT {key}, list_append(r.closed, r.open) AS c FROM packed))""",
        f"""chunks AS (
  SELECT md5({key} || chr(0) || chunk_index || chr(0) || text) AS chunk_id, chunk_index, text, {key} FROM chunk_texts)""",
    ]


DOC_CHUNKS = chunk_ctes("documents", "doc_id", fv.CHUNK_SIZE, fv.CHUNK_OVERLAP)
sql("chunk_documents", "SELECT chunk_id, chunk_index, text, doc_id FROM chunks", *DOC_CHUNKS)
sql("chunk_paragraphs", "SELECT chunk_id, chunk_index, text, doc_id FROM chunks",
    "spaced AS (SELECT doc_id, replace(text, chr(10), chr(10) || ' ' || chr(10)) AS text FROM documents)",
    *chunk_ctes("spaced", "doc_id", 600, 80))
sql("chunk_stats", """
SELECT count(*) AS n_chunks, count(DISTINCT chunk_id) AS n_ids, count(DISTINCT doc_id) AS n_docs,
       min(length(text)) AS min_chars, avg(length(text)) AS mean_chars, max(length(text)) AS max_chars FROM chunks""", *DOC_CHUNKS)
sql("text_coverage", """
SELECT count(*) FILTER (WHERE length(text) > 0) AS n_with_text, count(*) AS n_docs
FROM (SELECT DISTINCT doc_id FROM labels) LEFT JOIN documents USING (doc_id)""")
sql("sentence_split", f"""
SELECT doc_id, unnest(range(len(s))) AS n, unnest(s) AS sentence FROM (
  SELECT doc_id, list_filter(list_transform({split_sentences('text')}, lambda x: {strip('x')}), lambda x: x <> '') AS s FROM documents)""")
sql("fixed_slices", f"""
SELECT doc_id, unnest(range(len(s))) AS n, unnest(s) AS slice FROM (
  SELECT doc_id, {sliced('text', 1000)} AS s FROM documents WHERE length(text) > 0)""")
sql("delivery_slices", f"""
SELECT conv_id, turn, unnest(range(len(s))) AS piece_no, unnest(s) AS piece FROM (
  SELECT conv_id, turn, list_concat(CASE WHEN length(text) > 0 THEN {sliced('text', 80)} ELSE [] END,
    CASE WHEN contains(text, 'nicht') THEN [] ELSE [chr(10) || chr(10) || '---' || chr(10) || '*For information only.*'] END) AS s
  FROM conversations WHERE role = 'assistant')""")
sql("citation_check", r"""
SELECT conv_id, turn,
       CASE WHEN blocks = 0 THEN true WHEN len(c) = 0 THEN false
            ELSE len(list_filter(c, lambda n: CAST(n AS BIGINT) < 1 OR CAST(n AS BIGINT) > blocks)) = 0 END AS citations_ok,
       (length(text) - length(replace(text, '[Doc_', ''))) // 5 AS n_labels
FROM (SELECT conv_id, turn, text, blocks, regexp_extract_all(text, '\[Doc_(\d+)\]', 1) AS c FROM (
  SELECT conv_id, turn, turn % 5 AS blocks, text || CASE conv_id % 4 WHEN 0 THEN '' WHEN 1 THEN ' [Doc_1][Doc_' || turn || ']'
         WHEN 2 THEN ' [Doc_0] [Doc_2]' ELSE ' [Doc_x] [Doc_3]' END AS text
  FROM conversations WHERE role = 'assistant'))""")

# --- Search -----------------------------------------------------------------------------------

FOLD_FROM = "àâäáãåçèéêëîïíìñôöóòõùûüúÿßœæ"
FOLD_TO = "".join(chr(c) for c in range(33, 48)) + ":;<=>?@[]^`{|}~"


def single_bytes(expr: str) -> str:
    """Letters of several bytes as one byte each, since edit distance counts bytes."""
    return f"translate({expr}, {text(FOLD_FROM)}, {text(FOLD_TO[:len(FOLD_FROM)])})"


def tokens(expr: str) -> str:
    return f"regexp_extract_all(lower({expr}), '[\\p{{L}}\\p{{M}}\\p{{N}}]+')"


def corpus_words(source: str, key: str, fields) -> str:
    parts = [
        f"SELECT {key} AS id, '{name}' AS field, unnest({tokens(name)}) AS word FROM {source}" if kind == "text"
        else f"SELECT {key} AS id, '{name}' AS field, {name} AS word FROM {source} WHERE length({name}) > 0"
        for name, _, kind in fields]
    return "corpus_words AS (" + "\nUNION ALL ".join(parts) + ")"


def asked_words(source: str, fields) -> str:
    parts = [
        f"SELECT query_id, '{name}' AS field, unnest({tokens('query')}) AS word FROM {source}" if kind == "text"
        else f"SELECT query_id, '{name}' AS field, query AS word FROM {source}"
        for name, _, kind in fields]
    return "asked AS (SELECT query_id, field, word, count(*) AS n FROM (" + "\nUNION ALL ".join(parts) + ") GROUP BY ALL)"


MATCHES_FUZZY = f"""matches AS (
  SELECT field, word, known_word, CAST(distance AS BIGINT) AS distance FROM (
    SELECT a.field, a.word, v.word AS known_word,
           damerau_levenshtein({single_bytes('a.word')}, {single_bytes('v.word')}) AS distance
    FROM (SELECT DISTINCT field, word FROM asked) a JOIN vocab v
      ON a.field = v.field AND length(v.word) BETWEEN length(a.word) - 2 AND length(a.word) + 2)
  WHERE distance <= CASE WHEN length(word) <= 2 THEN 0 WHEN length(word) <= 5 THEN 1 ELSE 2 END)"""
MATCHES_EXACT = """matches AS (
  SELECT a.field, a.word, v.word AS known_word, 0 AS distance
  FROM (SELECT DISTINCT field, word FROM asked) a JOIN vocab v ON a.field = v.field AND a.word = v.word)"""


def ranking(fields, k: int, fuzzy: bool, name: str = "lexical") -> list[str]:
    boost = "CASE m.field " + " ".join(f"WHEN '{f}' THEN CAST({b} AS DOUBLE)" for f, b, _ in fields) + " END"
    keyword = ", ".join(f"'{f}'" for f, _, kind in fields if kind != "text") or "''"
    return [
        "lens AS (SELECT id, field, count(*) AS len FROM corpus_words GROUP BY ALL)",
        "field_stats AS (SELECT field, count(*) AS n_rows, avg(len) AS avg_len FROM lens GROUP BY field)",
        "vocab AS (SELECT field, word, count(DISTINCT id) AS df FROM corpus_words GROUP BY ALL)",
        MATCHES_FUZZY if fuzzy else MATCHES_EXACT,
        f"""weights AS (
  SELECT a.query_id, m.field, m.known_word AS word, s.avg_len,
         CASE WHEN m.field IN ({keyword}) THEN CAST(0 AS DOUBLE) ELSE CAST(0.75 AS DOUBLE) END AS b,
         sum({boost} * a.n * (1 - m.distance / CAST(least(length(m.word), length(m.known_word)) AS DOUBLE))
             * ln(1 + (s.n_rows - v.df + CAST(0.5 AS DOUBLE)) / (v.df + CAST(0.5 AS DOUBLE)))) AS weight
  FROM asked a JOIN matches m ON a.field = m.field AND a.word = m.word
  JOIN vocab v ON v.field = m.field AND v.word = m.known_word JOIN field_stats s ON s.field = m.field
  GROUP BY a.query_id, m.field, m.known_word, s.avg_len)""",
        "tfs AS (SELECT id, field, word, count(*) AS tf FROM corpus_words GROUP BY ALL)",
        """field_scores AS (
  SELECT w.query_id, t.id, t.field,
         sum(w.weight * t.tf / (t.tf + CAST(1.2 AS DOUBLE) * (1 - w.b + w.b * l.len / w.avg_len))) AS score
  FROM weights w JOIN tfs t ON w.field = t.field AND w.word = t.word JOIN lens l ON l.id = t.id AND l.field = t.field
  WHERE w.weight > 0 GROUP BY ALL)""",
        f"""{name} AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM (
    SELECT query_id, id, round(max(score), 6) AS score FROM field_scores GROUP BY query_id, id)) WHERE rank <= {k})""",
    ]


BENCHMARK_QUERIES = "queries AS (SELECT item_id AS query_id, text AS query FROM benchmark)"
PART_QUERIES = """queries AS (
  SELECT item_id AS query_id, text || ' ' || left(p_name, 1) || substr(p_name, 3, length(p_name) - 4) || right(p_name, 1)
         || substr(p_name, length(p_name) - 1, 1) || ' ' || lower(p_type) AS query
  FROM benchmark JOIN part ON item_id = p_partkey)"""
DOCUMENT_FIELDS = [("text", 1.0, "text")]

sql("bm25_documents", "SELECT query_id, id, score, rank FROM lexical", BENCHMARK_QUERIES,
    corpus_words("documents", "doc_id", DOCUMENT_FIELDS), asked_words("queries", DOCUMENT_FIELDS),
    *ranking(DOCUMENT_FIELDS, 10, False))
PART_SEARCH = [PART_SEED, PART_QUERIES, corpus_words("part_seed", "indicator_code", fv.SEARCH_FIELDS),
               asked_words("queries", fv.SEARCH_FIELDS)]
sql("lexical_indicators", "SELECT query_id, id, score, rank FROM lexical", *PART_SEARCH,
    *ranking(fv.SEARCH_FIELDS, 10, True))

ORACLE["search_stored"] = ORACLE["bm25_documents"]
CHANGED_PARTS = """changed_parts AS (
  SELECT indicator_code, indicator_name, category,
         CASE WHEN CAST(substr(indicator_code, 2) AS BIGINT) % 3 = 2 THEN lower(category) ELSE description END AS description
  FROM part_seed WHERE CAST(substr(indicator_code, 2) AS BIGINT) % 10 <> 7)"""
sql("search_after_update", "SELECT query_id, id, score, rank FROM lexical", PART_SEED, PART_QUERIES, CHANGED_PARTS,
    corpus_words("changed_parts", "indicator_code", fv.SEARCH_FIELDS), asked_words("queries", fv.SEARCH_FIELDS),
    *ranking(fv.SEARCH_FIELDS, 10, True))


def renamed(ctes: list[str], names: list[str], suffix: str) -> list[str]:
    """The same CTEs under other names, so that two searches fit in one statement."""
    import re

    result = []
    for cte in ctes:
        for name in names:
            cte = re.sub(rf"\b{name}\b", name + suffix, cte)
        result.append(cte)
    return result


SEARCH_NAMES = ["corpus_words", "asked", "lens", "field_stats", "vocab", "matches", "weights", "tfs", "field_scores", "lexical"]
CATALOGUE_FIELDS = [("title", 2.0, "text"), ("abstract", 1.0, "text"), ("topics", 1.0, "text")]
sql("search_all", """
SELECT query_id, id, score, rank, 'indicator' AS type FROM lexical
UNION ALL SELECT query_id, id, score, rank, 'document' FROM lexical_docs""",
    *PART_SEARCH, *ranking(fv.SEARCH_FIELDS, 5, False), CATALOGUE_DOCS,
    *renamed([corpus_words("docs", "doc_id", CATALOGUE_FIELDS), asked_words("queries", CATALOGUE_FIELDS),
              *ranking(CATALOGUE_FIELDS, 5, False)], SEARCH_NAMES, "_docs"))
sql("fuzzy_terms", "SELECT word, known_word, distance FROM matches", BENCHMARK_QUERIES,
    corpus_words("documents", "doc_id", DOCUMENT_FIELDS), asked_words("queries", DOCUMENT_FIELDS),
    "vocab AS (SELECT DISTINCT field, word FROM corpus_words)", MATCHES_FUZZY)
sql("search_postings", """
SELECT field, word, id, len, count(*) AS tf FROM corpus_words JOIN lens USING (id, field) GROUP BY ALL""",
    PART_SEED, corpus_words("part_seed", "indicator_code", fv.SEARCH_FIELDS),
    "lens AS (SELECT id, field, count(*) AS len FROM corpus_words GROUP BY ALL)")

COSINE = "list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))"


def near(queries: str, k: int, name: str) -> str:
    return f"""{name} AS (
  SELECT * FROM (SELECT b.query_id, a.vec_id AS id, round({COSINE}, 9) AS similarity,
           row_number() OVER (PARTITION BY b.query_id ORDER BY round({COSINE}, 9) DESC, a.vec_id) AS rank
    FROM embeddings a, {queries} b) WHERE rank <= {k})"""


sql("vector_topk", "SELECT query_id, id, round(similarity, 6) AS similarity, rank FROM near",
    """firsts AS (SELECT CAST(label AS BIGINT) AS query_id, embedding FROM embeddings
  WHERE vec_id IN (SELECT min(vec_id) FROM embeddings GROUP BY label))""", near("firsts", 20, "near"))
sql("vector_distances", f"""
SELECT a.vec_id, round(1 - {COSINE}, 6) AS distance
FROM embeddings a JOIN firsts b ON a.label = b.label""",
    "firsts AS (SELECT label, embedding FROM embeddings WHERE vec_id IN (SELECT min(vec_id) FROM embeddings GROUP BY label))")

SOURCE_VECTORS = """source_vectors AS (
  SELECT vec_id AS row_id, CASE WHEN label % 2 = 0 THEN 'P' || (vec_id % 50) ELSE CAST(vec_id % 200 AS VARCHAR) END AS source_id,
         CASE WHEN label % 2 = 0 THEN 'indicator' ELSE 'document' END AS source_type, CAST(label AS VARCHAR) AS label, embedding
  FROM embeddings)"""
sql("embedding_roundtrip", """
SELECT row_id, source_id, len(embedding) AS dimension, true AS same, source_id AS meta_id, label AS meta_label
FROM source_vectors""", SOURCE_VECTORS)
sql("hashed_embed", """
SELECT chunk_id, doc_id, slot, round((tf / sqrt(sum(tf * tf) OVER (PARTITION BY chunk_id, doc_id)))::FLOAT::DOUBLE, 5) AS weight
FROM slots""", *DOC_CHUNKS, f"""slots AS (
  SELECT chunk_id, doc_id, ('0x' || substr(md5(word), 1, 8))::BIGINT % 256 AS slot, count(*) AS tf
  FROM (SELECT chunk_id, doc_id, unnest({tokens('text')}) AS word FROM chunks) GROUP BY ALL)""")
sql("embedding_counts", """
SELECT count(*) FILTER (WHERE source_type = 'indicator') AS n_indicators,
       count(*) FILTER (WHERE source_type = 'document') AS n_documents, count(DISTINCT source_id) AS n_sources
FROM source_vectors""", SOURCE_VECTORS)
sql("embed_text_compose", """
SELECT 'indicator' AS source_type, indicator_code AS source_id,
       indicator_code || ' - ' || indicator_name || ' - Category: ' || category
       || CASE WHEN category <> 'promo' THEN ' - ' || description ELSE '' END AS text FROM part_seed
UNION ALL SELECT 'document', doc_id, 'Title: ' || title || chr(10) || 'Content: ' || abstract FROM docs""",
    PART_SEED, CATALOGUE_DOCS)


sql("embedding_store", """
SELECT 'indicator' AS source_type, source_id, text, metadata, vector FROM embedded
LEFT JOIN (SELECT source_id, string_agg(slot || ':' || CAST(round(weight * 100000) AS BIGINT), ' ' ORDER BY slot) AS vector
  FROM (SELECT source_id, slot, (tf / sqrt(sum(tf * tf) OVER (PARTITION BY source_id)))::FLOAT::DOUBLE AS weight FROM slots)
  GROUP BY source_id) USING (source_id)""", PART_SEED, """embedded AS (
  SELECT indicator_code AS source_id,
         indicator_code || ' - ' || indicator_name || ' - Category: ' || category || ' - ' || description AS text,
         CAST(json_object('indicator_code', indicator_code, 'indicator_name', indicator_name, 'category', category,
                          'description', description) AS VARCHAR) AS metadata FROM part_seed)""", f"""slots AS (
  SELECT source_id, ('0x' || substr(md5(word), 1, 8))::BIGINT % 32 AS slot, count(*) AS tf
  FROM (SELECT source_id, unnest({tokens('text')}) AS word FROM embedded) GROUP BY ALL)""")


def fused(name: str = "fused") -> list[str]:
    return [
        SOURCE_VECTORS,
        "item_vectors AS (SELECT item_id AS query_id, embedding FROM benchmark JOIN embeddings ON item_id = vec_id)",
        near("item_vectors", 15, "semantic"),
        """hits AS (
  SELECT query_id, l.id, rank, 0 AS list_no, 'Indicator' AS type,
         {'category': category, 'description': description, 'id': NULL::VARCHAR, 'indicator_code': indicator_code,
          'indicator_name': indicator_name, 'label': NULL::VARCHAR} AS props
  FROM lexical l JOIN part_seed ON l.id = indicator_code
  UNION ALL
  SELECT query_id, source_id, rank, 1, CASE WHEN source_type = 'indicator' THEN 'Indicator' ELSE 'Document' END,
         {'category': NULL, 'description': NULL, 'id': source_id, 'indicator_code': NULL, 'indicator_name': NULL, 'label': label}
  FROM semantic s JOIN source_vectors v ON s.id = v.row_id)""",
        f"""{name} AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id DESC) AS rank FROM (
    SELECT query_id, id, round(sum(CAST(1 AS DOUBLE) / (60 + rank)), 12) AS score, arg_min(type, list_no * 1000 + rank) AS type,
           arg_min(props, list_no * 1000 + rank) AS props
    FROM hits GROUP BY query_id, id)) WHERE rank <= 20)""",
    ]


RRF = [*PART_SEARCH, *ranking(fv.SEARCH_FIELDS, 15, True), *fused()]
sql("rrf_fusion", """
SELECT query_id, id, type, round(score, 9) AS score, rank,
       CASE WHEN props.indicator_code IS NOT NULL THEN 'category=' || props.category || '|description=' || props.description
              || '|indicator_code=' || props.indicator_code || '|indicator_name=' || props.indicator_name
            ELSE 'id=' || props.id || '|label=' || props.label END AS properties FROM fused""", *RRF)

# --- Reading questions -----------------------------------------------------------------------

ENDINGS = [
    " lạm phát Việt Nam 2019", " So sánh tăng trưởng ASEAN", " GDP của Indonesia và Thái Lan (2021)",
    " dân số thế giới", " xuất khẩu Malaysia trend", " thất nghiệp Philippines x2004 2005 2010",
    " đầu tư Singapore compare Laos", "",
]
QUESTIONS = f"""questions AS (
  SELECT conv_id * 1000 + turn AS query_id, text || e[1 + (conv_id + turn) % 8] AS query
  FROM conversations, (SELECT {texts(ENDINGS)} AS e) WHERE role = 'user')"""
RULES = ", ".join(f"({text(term)}, {texts(synonyms)})" for term, synonyms in fv.SYNONYMS)
sql("query_expansion", f"""
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY first) - 1 AS n, phrase FROM (
  SELECT query_id, phrase, min(place) AS first FROM (
    SELECT query_id, query AS phrase, 0 AS place FROM questions
    UNION ALL
    SELECT query_id, phrase, rule_no * 100 + s FROM (
      SELECT query_id, query, rule_no, unnest(range(len(synonyms))) AS s, unnest(synonyms) AS phrase
      FROM questions, rules WHERE contains(lower(query), term))
    WHERE NOT contains(lower(query), lower(phrase))) GROUP BY ALL)""", QUESTIONS,
    f"rules AS (SELECT row_number() OVER () AS rule_no, * FROM (VALUES {RULES}) t(term, synonyms))")
ALIASES = ", ".join(f"({i}, {text(name)}, {text(code)})" for i, (name, code) in enumerate(fv.COUNTRY_ALIASES))
REGION = " OR ".join(f"contains(lower(query), {text(w)})" for w in fv.REGION_WORDS)
COMPARISON = " OR ".join(f"contains(lower(query), {text(w)})" for w in fv.COMPARISON_WORDS)
sql("country_resolution", f"""
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY place) - 1 AS n, country_code FROM (
  SELECT query_id, code AS country_code, min(a) AS place FROM questions, aliases
  WHERE contains(lower(query), name) AND NOT ({REGION}) GROUP BY query_id, code
  UNION ALL
  SELECT query_id, unnest({texts(fv.REGION_COUNTRIES)}), unnest(range({len(fv.REGION_COUNTRIES)})) FROM questions WHERE {REGION}
  UNION ALL
  SELECT query_id, 'VNM', 0 FROM questions WHERE NOT ({REGION})
    AND NOT EXISTS (SELECT 1 FROM aliases WHERE contains(lower(query), name)))""", QUESTIONS,
    f"aliases AS (SELECT * FROM (VALUES {ALIASES}) t(a, name, code))")
sql("question_flags", rf"""
SELECT query_id, ({COMPARISON}) AS is_comparison,
       CAST(nullif(regexp_extract(query, '(?:^|[^\p{{L}}\p{{M}}\p{{N}}_])(20\d{{2}})(?:$|[^\p{{L}}\p{{M}}\p{{N}}_])', 1), '') AS BIGINT) AS year
FROM questions""", QUESTIONS)

# --- Graph -----------------------------------------------------------------------------------

DOC_COUNTRY = """doc_country AS (
  SELECT DISTINCT doc_id, country_code FROM (
    SELECT doc_id, trim(unnest(string_split(countries, ';'))) AS listed FROM docs) l
  JOIN dim_countries c ON l.listed = c.country_name OR l.listed = c.country_code)"""
NODES = """nodes AS (
  SELECT 'Country' AS type, country_code AS id, 'code=' || country_code || '|income_group=' || income_group || '|name='
         || coalesce(country_name, '') || '|region=' || region AS properties FROM dim_countries
  UNION ALL SELECT 'Indicator', indicator_code, 'code=' || indicator_code || '|description=' || description || '|name='
         || indicator_name || '|source_system=' || source_system || '|unit=' || unit FROM dim_indicators
  UNION ALL SELECT DISTINCT 'IndicatorCategory', category, 'name=' || category FROM dim_indicators
  UNION ALL SELECT 'Document', doc_id, 'abstract=' || abstract || '|doc_id=' || doc_id || '|doc_type=' || doc_type
         || '|title=' || title || '|topics=' || topics FROM docs)"""
EDGES = """edges AS (
  SELECT 'Indicator' AS src_type, indicator_code AS src, 'BELONGS_TO' AS rel, 'IndicatorCategory' AS dst_type, category AS dst
  FROM dim_indicators
  UNION ALL SELECT DISTINCT 'Country', country_code, 'HAS_INDICATOR', 'Indicator', indicator_code
  FROM fact JOIN dim_countries USING (country_key) JOIN dim_indicators USING (indicator_key)
  UNION ALL SELECT 'Document', doc_id, 'ABOUT', 'Country', country_code FROM doc_country)"""
GRAPH = [*TRADE_GOLD, CATALOGUE_DOCS, DOC_COUNTRY, NODES, EDGES]
sql("graph_nodes", "SELECT * FROM nodes", *GRAPH)
sql("graph_edges", "SELECT * FROM edges", *GRAPH)
sql("doc_country_edges", "SELECT doc_id, country_code FROM doc_country", *ORDER_GOLD, CATALOGUE_DOCS, DOC_COUNTRY)
sql("doc_topic_edges", """
SELECT DISTINCT doc_id, topic FROM (SELECT doc_id, unnest(string_split(topics, ';')) AS topic FROM docs)
UNION ALL SELECT DISTINCT '', unnest(string_split(topics, ';')) FROM docs""", CATALOGUE_DOCS)
sql("graph_upsert", """
SELECT 'node' AS kind, 'Country' AS label, country_code AS id, 'The ' || country_code AS name, '' AS target,
       'code=' || country_code || '|income_group=' || income_group || '|name=The ' || country_code || '|region=' || region AS properties
FROM dim_countries
UNION ALL
SELECT 'node', type, id, coalesce(indicator_name, title, id), '', properties
FROM nodes LEFT JOIN dim_indicators i ON type = 'Indicator' AND id = i.indicator_code
LEFT JOIN docs d ON type = 'Document' AND id = d.doc_id WHERE type <> 'Country'
UNION ALL
SELECT 'edge', rel, src_type || ':' || src, '', dst_type || ':' || dst, '' FROM (
  SELECT src_type, src, rel, dst_type, dst FROM edges UNION
  SELECT 'Country', 'NATION_' || s_nationkey, 'HAS_INDICATOR', 'Indicator', 'P' || s_suppkey FROM supplier
  WHERE 'P' || s_suppkey IN (SELECT indicator_code FROM dim_indicators))""", *GRAPH)
sql("lineage_paths", """
SELECT a.conv_id || ':' || a.turn AS message, b.conv_id || ':' || b.turn AS upstream
FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn IN (a.turn - 1, a.turn - 2)
WHERE b.turn = a.turn - 1 OR EXISTS (SELECT 1 FROM conversations m WHERE m.conv_id = a.conv_id AND m.turn = a.turn - 1)""")

CHAIN = """chain AS (
  SELECT i.indicator_code AS i, i.category AS cat, h.src AS c, d.doc_id AS d
  FROM dim_indicators i
  LEFT JOIN (SELECT src, dst FROM edges WHERE rel = 'HAS_INDICATOR') h ON h.dst = i.indicator_code
  LEFT JOIN (SELECT dc.country_code, t.doc_id, t.topics, t.title FROM doc_country dc JOIN docs t ON dc.doc_id = t.doc_id) d
    ON d.country_code = h.src AND (contains(d.topics, i.category) OR contains(d.title, i.indicator_name)))"""
INDICATOR_ROWS = """indicator_rows AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY cat, c, d) AS row_no FROM chain) WHERE row_no <= 40)"""
COUNTRY_ROWS = """country_rows AS (
  SELECT * FROM (SELECT c.country_code AS c, h.dst AS i, i.category AS cat,
      row_number() OVER (PARTITION BY c.country_code ORDER BY h.dst, i.category) AS row_no
    FROM dim_countries c LEFT JOIN (SELECT src, dst FROM edges WHERE rel = 'HAS_INDICATOR') h ON h.src = c.country_code
    LEFT JOIN dim_indicators i ON i.indicator_code = h.dst) WHERE row_no <= 30)"""
sql("graph_expand_indicator", "SELECT i, cat, c, d, row_no FROM indicator_rows", *GRAPH, CHAIN, INDICATOR_ROWS)
sql("graph_expand_country", "SELECT c, i, cat, row_no FROM country_rows", *GRAPH, COUNTRY_ROWS)

ANCHORS = """anchors AS (
  SELECT item_id AS query_id, 1 AS rank, 'Indicator' AS type, 'P' || item_id AS id FROM benchmark
  UNION ALL SELECT item_id, 2, 'Indicator', 'P' || (item_id + 1) FROM benchmark
  UNION ALL SELECT item_id, 3, 'Country', 'NATION_' || (item_id % 25) FROM benchmark
  UNION ALL SELECT item_id, 4, 'Document', CAST(item_id AS VARCHAR) FROM benchmark)"""
LINEAGE_COLUMNS = {
    "stg_observations": ["country_code", "country_name", "indicator_code", "indicator_name", "year", "value", "ingested_at"],
    "dim_countries": ["country_key", "country_code", "country_name", "region", "income_group", "is_asean", "is_primary"],
    "dim_indicators": ["indicator_key", "indicator_code", "indicator_name", "source_system", "category", "unit", "frequency", "description"],
    "dim_dates": ["date_key", "full_date", "year", "quarter", "month", "month_name", "day_of_week", "is_weekend", "is_vietnam_holiday", "fiscal_year_vn"],
    "fact_economic_indicators": ["indicator_key", "country_key", "date_key", "period_start", "period_end", "value", "source_system", "loaded_at"],
}
UPSTREAM = [
    ("dim_countries", "stg_observations"), ("fact_economic_indicators", "dim_countries"),
    ("fact_economic_indicators", "dim_indicators"), ("fact_economic_indicators", "dim_dates"),
    ("fact_economic_indicators", "stg_observations"), ("dim_indicators", "stg_observations"),
]
LINEAGE = [
    "contained AS (SELECT * FROM (VALUES " + ", ".join(
        f"('{t}', '{c}')" for t, cs in LINEAGE_COLUMNS.items() for c in cs) + ") t(tab, col))",
    "upstream AS (SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in UPSTREAM) + ") t(tab, src))",
    """derived AS (
  SELECT a.tab || '.' || a.col AS col, b.tab || '.' || b.col AS up
  FROM contained a JOIN upstream u ON a.tab = u.tab JOIN contained b ON b.tab = u.src AND b.col = a.col)""",
    """derived_two AS (
  SELECT col, up FROM derived UNION SELECT a.col, b.up FROM derived a JOIN derived b ON a.up = b.col)""",
]
sql("graph_expand_lineage", """
SELECT * FROM (
  SELECT ch.i, ch.cat, ch.c, 'fact_economic_indicators' AS src, 'fact_economic_indicators.' || k.col AS col, u.up, ch.d,
         row_number() OVER (PARTITION BY ch.i ORDER BY cat, c, 'fact_economic_indicators.' || k.col, u.up, d) AS row_no
  FROM (SELECT * FROM chain WHERE i IN (SELECT id FROM anchors WHERE type = 'Indicator')) ch
  JOIN contained k ON k.tab = 'fact_economic_indicators'
  LEFT JOIN derived_two u ON u.col = 'fact_economic_indicators.' || k.col) WHERE row_no <= 40""",
    *GRAPH, CHAIN, ANCHORS, *LINEAGE)


def expansion(max_nodes: int) -> list[str]:
    return [
        """reached AS (
  SELECT 'Indicator' AS anchor_type, i AS anchor, type, id, min(place) AS place FROM (
    SELECT i, 'Indicator' AS type, i AS id, row_no * 7 AS place FROM indicator_rows
    UNION ALL SELECT i, 'IndicatorCategory', cat, row_no * 7 + 1 FROM indicator_rows
    UNION ALL SELECT i, 'Country', c, row_no * 7 + 2 FROM indicator_rows
    UNION ALL SELECT i, 'Document', d, row_no * 7 + 6 FROM indicator_rows) WHERE id IS NOT NULL GROUP BY ALL
  UNION ALL
  SELECT 'Country', c, type, id, min(place) FROM (
    SELECT c, 'Country' AS type, c AS id, row_no * 3 AS place FROM country_rows
    UNION ALL SELECT c, 'Indicator', i, row_no * 3 + 1 FROM country_rows
    UNION ALL SELECT c, 'IndicatorCategory', cat, row_no * 3 + 2 FROM country_rows) WHERE id IS NOT NULL GROUP BY ALL)""",
        f"""expanded AS (
  SELECT * FROM (SELECT query_id, type, id, row_number() OVER (PARTITION BY query_id ORDER BY first, type, id) AS place FROM (
    SELECT a.query_id, r.type, r.id, min(a.rank * 1000000 + r.place) AS first
    FROM anchors a JOIN reached r ON r.anchor_type = a.type AND r.anchor = a.id GROUP BY ALL)) WHERE place <= {max_nodes})""",
    ]


EXPANSION = [*GRAPH, CHAIN, INDICATOR_ROWS, COUNTRY_ROWS, ANCHORS, *expansion(50)]
sql("graph_expand", "SELECT query_id, place, type, id FROM expanded", *EXPANSION)

# --- Context -------------------------------------------------------------------------------------

WEIGHT = "CASE type " + " ".join(f"WHEN '{t}' THEN CAST({w} AS DOUBLE)" for t, w in fv.TYPE_WEIGHTS) + " ELSE CAST(1 AS DOUBLE) END"
NODE_PROPS = """node_props AS (
  SELECT 'Country' AS type, country_code AS id, country_name AS name, NULL::VARCHAR AS description,
         NULL::VARCHAR AS category, region, income_group, NULL::VARCHAR AS title, NULL::VARCHAR AS content FROM dim_countries
  UNION ALL SELECT 'Indicator', indicator_code, indicator_name, description, NULL, NULL, NULL, NULL, NULL FROM dim_indicators
  UNION ALL SELECT DISTINCT 'IndicatorCategory', category, category, NULL, NULL, NULL, NULL, NULL, NULL FROM dim_indicators
  UNION ALL SELECT 'Document', doc_id, NULL, NULL, NULL, NULL, NULL, title, abstract FROM docs)"""


def ranked(both: str, dropped: str, k: int, dedupe: bool = True) -> list[str]:
    return [
        both,
        f"""ranked AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, part, place) AS rank FROM (
    SELECT *, {WEIGHT} AS score FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id, type, id ORDER BY part, place) AS seen FROM both_nodes)
    WHERE {"seen = 1 AND " if dedupe else ""}{dropped})) WHERE rank <= {k})""",
    ]


BLOCKS = """blocks AS (
  SELECT query_id, rank, '[Doc_' || rank || '] | Type: ' || CASE type
    WHEN 'Indicator' THEN 'Indicator' || chr(10) || 'Code: ' || id || ' | Category: ' || coalesce(category, '') || chr(10)
      || 'Name: ' || coalesce(name, '') || chr(10) || 'Description: ' || coalesce(description, '') || chr(10)
    WHEN 'Country' THEN 'Country' || chr(10) || 'Code: ' || id || ' | Name: ' || coalesce(name, '') || chr(10) || 'Region: '
      || coalesce(region, '') || ' | Income: ' || coalesce(income_group, '') || chr(10)
    WHEN 'Document' THEN 'Document' || chr(10) || 'Title: ' || coalesce(title, '') || chr(10) || 'Content: '
      || left(coalesce(content, ''), 1000) || chr(10)
    ELSE type || ' | ID: ' || id || chr(10) END AS block
  FROM shown)"""
CONTEXTS = """contexts AS (
  SELECT query_id, string_agg(block, chr(10) ORDER BY rank) AS context FROM (
    SELECT *, coalesce(sum(length(block)) OVER (PARTITION BY query_id ORDER BY rank
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM blocks) WHERE used <= 24000 GROUP BY query_id)"""
FORMATTED = "format('{:,}', CAST(split_part(CAST(value AS VARCHAR), '.', 1) AS BIGINT)) || '.' || split_part(CAST(value AS VARCHAR), '.', 2)"


def facts(asked: str) -> list[str]:
    return [
        NAMED, LATEST, asked,
        """looked_up AS (
  SELECT q.query_id, q.node_rank, q.country_no, f.* FROM fact_asked q JOIN named f
    ON f.country_code = q.country_code AND f.indicator_code = q.indicator_code
  WHERE q.is_comparison OR f.year = q.year
  UNION ALL
  SELECT q.query_id, q.node_rank, q.country_no, f.* FROM fact_asked q JOIN latest f
    ON f.country_code = q.country_code AND f.indicator_code = q.indicator_code
  WHERE NOT q.is_comparison AND q.year IS NULL)""",
        f"""fact_lines AS (
  SELECT query_id, node_rank, country_no, year, 'FACT: ' || country_name || ' - ' || indicator_name || ' (' || year || '): '
         || {FORMATTED} || ' ' || unit AS line FROM looked_up)""",
    ]


ANCHORED = [*EXPANSION, NODE_PROPS, *ranked("""both_nodes AS (
  SELECT query_id, 0 AS part, rank AS place, a.type, a.id FROM anchors a JOIN node_props p ON a.type = p.type AND a.id = p.id
  UNION ALL SELECT query_id, 1, place, type, id FROM expanded)""", "id <> 'P7'", 100)]
sql("rerank_nodes", "SELECT query_id, rank, type, id, score FROM ranked", *ANCHORED)
sql("layer_boost", """
SELECT doc_id, CAST(CASE lang WHEN 'en' THEN 3 WHEN 'fr' THEN 2 ELSE 1 END AS DOUBLE) AS score FROM documents WHERE lang <> 'es'""")
SHOWN = "shown AS (SELECT r.query_id, r.rank, p.* FROM ranked r JOIN node_props p ON r.type = p.type AND r.id = p.id)"
sql("assemble_context", "SELECT query_id, context FROM contexts", *ANCHORED, SHOWN, BLOCKS, CONTEXTS)
sql("fact_lines", "SELECT query_id, node_rank, country_no, CAST(year AS BIGINT) AS year, line FROM fact_lines", *ANCHORED, *facts("""fact_asked AS (
  SELECT r.query_id, r.rank AS node_rank, r.id AS indicator_code, r.query_id % 3 = 0 AS is_comparison,
         CASE WHEN r.query_id % 3 = 1 THEN 1999 END AS year, k AS country_no,
         'NATION_' || ((r.query_id + 5 * k) % 25) AS country_code
  FROM ranked r, range(2) t(k) WHERE r.type = 'Indicator')"""))


def shifted(named: str, years: int) -> str:
    """The named facts, dated some years later."""
    later = f"CAST(f.period_start + INTERVAL {years} YEAR AS DATE)"
    return named.replace(", f.period_start,", f", {later} AS period_start,").replace("FROM f.period_start)", f"FROM {later})")


# The whole batch: the anchors come from the fused hits and show the properties found there.
def retrieval(name: str, raw_queries: str, asked: str, dedupe: bool = True, years_later: int = 0) -> None:
    ctes = [
        *GRAPH, CHAIN, INDICATOR_ROWS, COUNTRY_ROWS, raw_queries,
        f"""queries AS (
  SELECT query_id, string_agg(phrase, ' ' ORDER BY place) AS query, any_value(raw) AS raw FROM (
    SELECT query_id, query AS raw, query AS phrase, 0 AS place FROM raw_queries
    UNION ALL
    SELECT query_id, query, phrase, rule_no * 100 + s FROM (
      SELECT query_id, query, rule_no, unnest(range(len(synonyms))) AS s, unnest(synonyms) AS phrase
      FROM raw_queries, (SELECT row_number() OVER () AS rule_no, * FROM (VALUES {RULES}) t(term, synonyms))
      WHERE contains(lower(query), term)) WHERE NOT contains(lower(query), lower(phrase))) GROUP BY query_id)""",
        corpus_words("part_seed", "indicator_code", fv.SEARCH_FIELDS), asked_words("queries", fv.SEARCH_FIELDS),
        *ranking(fv.SEARCH_FIELDS, 15, True), *fused("anchors"), *expansion(50), NODE_PROPS,
        *ranked("""both_nodes AS (
  SELECT query_id, 0 AS part, rank AS place, type, id FROM anchors
  UNION ALL SELECT query_id, 1, place, type, id FROM expanded)""", "true", 70, dedupe),
        """shown AS (
  SELECT r.query_id, r.rank, r.type, r.id, a.props.indicator_name AS name, a.props.description AS description,
         a.props.category AS category, NULL::VARCHAR AS region, NULL::VARCHAR AS income_group, NULL::VARCHAR AS title, NULL::VARCHAR AS content
  FROM ranked r JOIN anchors a ON r.query_id = a.query_id AND r.type = a.type AND r.id = a.id WHERE r.part = 0
  UNION ALL
  SELECT r.query_id, r.rank, r.type, r.id, p.name, p.description, p.category, p.region, p.income_group, p.title, p.content
  FROM ranked r JOIN node_props p ON r.type = p.type AND r.id = p.id WHERE r.part = 1)""",
        BLOCKS, CONTEXTS,
        *[shifted(cte, years_later) if cte == NAMED and years_later else cte for cte in facts(asked)],
    ]
    sql(name, f"""
SELECT q.query_id, q.raw AS query,
       coalesce(c.context || coalesce((SELECT chr(10) || chr(10) || '{fv.FACTS_HEADING}' || chr(10)
         || string_agg(line, chr(10) ORDER BY node_rank, country_no, year) FROM fact_lines f WHERE f.query_id = q.query_id), ''),
         {text(fv.NO_CONTEXT_MESSAGE)}) AS context,
       (SELECT count(*) FROM ranked r WHERE r.query_id = q.query_id) AS n_nodes
FROM queries q LEFT JOIN contexts c ON q.query_id = c.query_id""", *ctes)


retrieval("retrieve_context", PART_QUERIES.replace("queries AS", "raw_queries AS"), f"""fact_asked AS (
  SELECT r.query_id, r.rank AS node_rank, r.id AS indicator_code, ({COMPARISON.replace('query', 'q.raw')}) AS is_comparison,
         CAST(NULL AS INTEGER) AS year, 0 AS country_no, 'VNM' AS country_code
  FROM ranked r JOIN queries q ON r.query_id = q.query_id WHERE r.type = 'Indicator')""")
retrieval("retrieve_facts", PART_QUERIES.replace("queries AS", "plain_queries AS") + """,
raw_queries AS (
  SELECT query_id, query || CASE query_id % 4
           WHEN 0 THEN ' of nation_' || (query_id % 25) || ' and nation_' || ((query_id + 5) % 25) || ' compare'
           WHEN 1 THEN ' of nation_' || (query_id % 25) || ' 2005' WHEN 2 THEN ' of nation_' || (query_id % 25) ELSE '' END AS query
  FROM plain_queries)""", f"""mentions AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY n) - 1 AS country_no, 'NATION_' || n AS country_code FROM (
    SELECT query_id, query_id % 25 AS n FROM queries WHERE query_id % 4 < 3
    UNION SELECT query_id, (query_id + 5) % 25 FROM queries WHERE query_id % 4 = 0)
), fact_asked AS (
  SELECT r.query_id, r.rank AS node_rank, r.id AS indicator_code, ({COMPARISON.replace('query', 'q.raw')}) AS is_comparison,
         CASE WHEN q.query_id % 4 = 1 THEN 2005 END AS year, country_no, country_code
  FROM ranked r JOIN queries q ON r.query_id = q.query_id JOIN mentions m ON m.query_id = r.query_id
  WHERE r.type = 'Indicator')""", dedupe=False, years_later=10)


# --- Chat ------------------------------------------------------------------------------------------

UUID = """substr(md5(CAST(conv_id AS VARCHAR)), 1, 8) || '-' || substr(md5(CAST(conv_id AS VARCHAR)), 9, 4) || '-'
  || substr(md5(CAST(conv_id AS VARCHAR)), 13, 4) || '-' || substr(md5(CAST(conv_id AS VARCHAR)), 17, 4) || '-'
  || substr(md5(CAST(conv_id AS VARCHAR)), 21, 12)"""
MESSAGES = f"""messages AS (
  SELECT {UUID} AS session_id, role, text AS content,
         TIMESTAMP '2024-01-01' + to_seconds(conv_id * 60 + turn) AS created_at FROM conversations)"""
sql("chat_sessions_recent", """
SELECT session_id AS id, 'Chat ' || left(session_id, 8) AS title, min(created_at) AS created_at
FROM messages GROUP BY session_id ORDER BY created_at DESC, id LIMIT 5""", MESSAGES)
sql("chat_messages_recent", """
SELECT session_id, role, left(content, 50) AS content, created_at FROM messages
ORDER BY messages.created_at DESC, session_id LIMIT 5""", MESSAGES)
sql("append_messages", f"""
SELECT {UUID} AS session_id, count(*) AS n_messages FROM conversations WHERE conv_id % 3 <> 2 GROUP BY conv_id
UNION ALL SELECT 'new', count(*) FROM conversations WHERE conv_id % 3 = 2
UNION ALL SELECT 'all', count(*) FROM conversations""")

sql("stored_messages", f"""
SELECT CASE WHEN conv_id % 3 <> 2 THEN {UUID} END AS session_id, role, text AS content,
       CASE WHEN conv_id % 3 = 2 THEN true END AS is_titled
FROM conversations WHERE role IN ('user', 'assistant')""")
sql("graph_node_ids", """
SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'P' || page_id WHEN 1 THEN coalesce(nullif(url, ''), 'node-' || page_id)
                     WHEN 2 THEN CAST(page_id AS VARCHAR) ELSE 'node-' || page_id END AS node FROM pages""")
sql("embed_hook", """
SELECT p_partkey, CAST(length(p_name) AS DOUBLE) AS n_chars,
       CAST(length(p_name) - length(replace(p_name, ' ', '')) AS DOUBLE) AS n_blanks,
       CAST(length(p_name) - length(regexp_replace(p_name, '[aeiou]', '', 'g')) AS DOUBLE) AS n_vowels FROM part""")

# --- Event metrics ---------------------------------------------------------------------------------


def windowed(width: str) -> str:
    return f"time_bucket(INTERVAL '{width}', ts) AS window_start, time_bucket(INTERVAL '{width}', ts) + INTERVAL '{width}' AS window_end"


sql("rate_per_minute", f"""
SELECT {windowed('1 minute')}, event_type, count(*) AS n_events, count(*) / CAST(60 AS DOUBLE) AS rate
FROM events GROUP BY ALL""")
sql("error_rate", f"""
SELECT *, n_errors / CAST(600 AS DOUBLE) AS error_rate FROM (
  SELECT {windowed('10 minutes')}, count(*) FILTER (WHERE event_type = 'error') AS n_errors, count(*) AS n_events
  FROM events GROUP BY ALL)""")
sql("total_count", "SELECT event_type, count(*) AS n_events FROM events GROUP BY event_type")
sql("increase_5m", """
SELECT time_bucket(INTERVAL '1 minute', ts) - to_minutes(k) AS window_start,
       time_bucket(INTERVAL '1 minute', ts) - to_minutes(k) + INTERVAL '5 minutes' AS window_end, event_type, count(*) AS n_events
FROM events, range(5) t(k) GROUP BY ALL""")
sql("rate_limit_violations", f"""
SELECT {windowed('1 day')}, user_id, count(*) AS n_events FROM events GROUP BY ALL HAVING count(*) > 5""")
BOUNDS = [5, 10, 25, 50, 75, 100, 150, 200, 300]
sql("p95_window", f"""
SELECT window_start, window_end, n_events, round(coalesce(min(CASE WHEN cum >= wanted AND below < wanted THEN
         low + (high - low) * (wanted - below) / CAST(cum - below AS DOUBLE) END), 300), 6) AS quantile
FROM (
  SELECT w.*, b.low, b.high, n_events * CAST(0.95 AS DOUBLE) AS wanted,
         (SELECT count(*) FROM timed e WHERE e.window_start = w.window_start AND e.value <= b.high) AS cum,
         CASE WHEN b.low = 0 THEN 0 ELSE (SELECT count(*) FROM timed e WHERE e.window_start = w.window_start AND e.value <= b.low) END AS below
  FROM (SELECT window_start, window_end, count(*) AS n_events FROM timed GROUP BY ALL) w, bounds b)
GROUP BY ALL""", f"timed AS (SELECT {windowed('1 hour')}, value FROM events)",
    "bounds AS (SELECT * FROM (VALUES " + ", ".join(
        f"(CAST({lo} AS DOUBLE), CAST({hi} AS DOUBLE))" for lo, hi in zip([0, *BOUNDS[:-1]], BOUNDS)) + ") t(low, high))")

# The streamed metrics end with all windows, those that are still open included.
for streamed, batch in (("stream_rate_per_minute", "rate_per_minute"), ("stream_p95_window", "p95_window"),
                        ("stream_increase_5m", "increase_5m")):
    ORACLE[streamed] = ORACLE[batch]
