"""What the queries must return, as DuckDB SQL straight over the test tables."""

SENTINEL = "not available in demo dataset"

# Raw visits as text (the cleaned columns are derived from these by hand below).
_EVENTS = "ev AS (SELECT *, json_extract_string(props, '$.k') AS k FROM events)"

_RAW_COLUMNS = f"""
    CASE k WHEN '7' THEN NULL WHEN '21' THEN 'user {SENTINEL}' WHEN '22' THEN ''
           ELSE user_id::VARCHAR END AS "fullVisitorId",
    CASE k WHEN '13' THEN NULL ELSE event_id::VARCHAR END AS "visitId",
    k AS "visitNumber",
    CASE k WHEN '50' THEN 'not-a-date' WHEN '51' THEN '20240230' WHEN '52' THEN NULL
           ELSE strftime(ts, '%Y%m%d') END AS "date",
    floor(epoch(ts))::BIGINT::VARCHAR AS "visitStartTime",
    CASE event_type WHEN 'signup' THEN 'Direct' WHEN 'click' THEN 'Organic Search'
           WHEN 'view' THEN 'Referral' WHEN 'purchase' THEN 'Social'
           ELSE '({SENTINEL})' END AS "channelGrouping",
    CASE event_type WHEN 'signup' THEN 'Socially Engaged'
           ELSE 'Not Socially Engaged' END AS "socialEngagementType",
"""



def _in(ks: list[str]) -> str:
    return "k IN (" + ", ".join(f"'{k}'" for k in ks) + ")"


def _metrics(unreadable: list[str]) -> str:
    """The four numbers; ``unreadable`` lists the k whose totals give none at all."""
    none = f"{_in(unreadable)} OR k IS NULL"
    return f"""
    CASE WHEN {none} THEN NULL WHEN k = '33' THEN 2 ELSE 1 END::INTEGER AS visits,
    CASE WHEN {none} OR k IN ('33', '35') THEN NULL WHEN k = '32' THEN 2
         WHEN event_type = 'view' THEN k::INTEGER END::INTEGER AS pageviews,
    CASE WHEN {none} OR k IN ('32', '33', '35') THEN NULL
         WHEN event_type = 'purchase' THEN 1 END::INTEGER AS transactions,
    CASE WHEN {none} OR k IN ('32', '35') THEN NULL WHEN k = '33' THEN 1000
         WHEN event_type = 'purchase' THEN value END::DOUBLE AS "transactionRevenue"
    """


def _hit(unreadable: list[str]) -> str:
    """The first hit; ``unreadable`` lists the k whose hits give four NULLs."""
    none = f"{_in(unreadable)} OR k IS NULL"
    return f"""
    CASE WHEN {none} THEN NULL ELSE upper(event_type) END AS "hitType",
    CASE WHEN {none} OR k = '46' THEN NULL
         WHEN k LIKE '9_' THEN '/' || event_type || '/' || k || '/it''s'
         ELSE '/' || event_type || '/' || k END AS "pagePath",
    CASE WHEN {none} OR k = '46' THEN NULL WHEN event_type = 'view' THEN 'false'
         ELSE 'true' END AS "isInteraction",
    CASE WHEN {none} OR k = '46' THEN NULL
         WHEN event_type = 'click' THEN 'https://ref.example/' || k END AS referer
    """


_BAD_TOTALS = ["30", "31", "34"]
_BAD_HITS = ["40", "41", "42", "43", "45", "47", "49"]
# A placeholder inside the text makes these unreadable too, once it has been cleaned.
_CLEANED_TOTALS = [*_BAD_TOTALS, "35"]
_CLEANED_HITS = [*_BAD_HITS, "48"]

_KPI = f"""
WITH {_EVENTS},
raw AS (
  SELECT {_RAW_COLUMNS} {_metrics(_CLEANED_TOTALS)}, {_hit(_CLEANED_HITS)} FROM ev),
kpi AS (
  SELECT * REPLACE (nullif("channelGrouping", '({SENTINEL})') AS "channelGrouping")
  FROM raw
  WHERE "fullVisitorId" NOT LIKE '%{SENTINEL}%' AND "visitId" IS NOT NULL
)
"""


def over_kpi(select: str) -> str:
    return f"{_KPI} {select}"


_KPI_COLUMNS = """
    "fullVisitorId", "date", "visitId", "visitNumber", "visitStartTime", "channelGrouping",
    "socialEngagementType", visits, pageviews, transactions, "transactionRevenue",
    "hitType", "pagePath", "isInteraction", referer
"""
KPI_ROWS = over_kpi(f"SELECT {_KPI_COLUMNS} FROM kpi")

_DEVICE = """
    CASE WHEN k IN ('60','61','62') THEN NULL
         ELSE '{"browser":"chrome","info":"{\\"k\\":' || k || '}"}' END
"""
_DIMENSIONS = """
    CASE WHEN k = '63' THEN '[]' WHEN k IN ('64','65') THEN NULL
         ELSE '[{"index":"4","value":"' || event_type || '"}]' END
"""

# The totals and hits of raw visits as text, for the checks that keep them.
_RAW_TEXTS = f"""
    CASE k
      WHEN '30' THEN '{{broken' WHEN '31' THEN NULL
      WHEN '32' THEN '{{"visits":1,"pageviews":2}}'
      WHEN '33' THEN '{{"visits": "2.5", "pageviews": "99999999999", "transactions": "x", '
                     || '"transactionRevenue": "1e3"}}'
      WHEN '34' THEN '{{"VISITS": "1"}}' WHEN '35' THEN NULL
      ELSE '{{"visits": "1"' || CASE event_type
             WHEN 'view' THEN ', "pageviews": "' || k || '"'
             WHEN 'purchase' THEN ', "transactions": "1", "transactionRevenue": "'
                                  || value::VARCHAR || '"'
             ELSE '' END || ', "bounces": {{"n": 1}}}}' END AS totals,
    CASE
      WHEN k = '40' THEN 'oops(' WHEN k = '41' THEN '' WHEN k = '42' THEN '[]'
      WHEN k IN ('43','48') THEN NULL WHEN k = '49' THEN '[''A'']'
      WHEN k = '44' THEN first_hit
      WHEN k = '45' THEN '[{{''type'': ''' || upper(event_type) || ''', ''page'': None}}]'
      WHEN k = '46' THEN '[{{''type'': ''' || upper(event_type) || '''}}]'
      WHEN k = '47' THEN '[{{"type": "' || upper(event_type)
                         || '", "isInteraction": true, "referer": null}}]'
      WHEN k LIKE '9_' THEN '[{{''type'': ''' || upper(event_type)
           || ''', ''page'': {{''pagePath'': "/' || event_type || '/' || k
           || '/it''s"}}, ''isInteraction'': ' || interaction || ', ''referer'': ' || ref
           || '}}, ' || second_hit || ']'
      ELSE '[' || first_hit || ', ' || second_hit || ']' END AS hits
"""

CLEAN_RAW = f"""
WITH {_EVENTS},
parts AS (
  SELECT *,
    CASE WHEN event_type = 'view' THEN 'False' ELSE 'True' END AS interaction,
    CASE WHEN event_type = 'click' THEN '''https://ref.example/' || k || ''''
         ELSE 'None' END AS ref,
    '{{''hitNumber'': 2, ''type'': ''EXIT'', ''page'': {{''pagePath'': ''/exit''}}, '
      || '''time'': 12.50}}' AS second_hit
  FROM ev
), hits AS (
  SELECT *,
    '{{''hitNumber'': 1, ''type'': ''' || upper(event_type)
      || ''', ''page'': {{''pagePath'': ''/' || event_type || '/' || k
      || ''', ''hostname'': ''shop.example''}}, ''isInteraction'': ' || interaction
      || ', ''referer'': ' || ref || '}}' AS first_hit
  FROM parts
), raw AS (
  SELECT {_RAW_COLUMNS}
    {_DEVICE} AS device,
    {_DIMENSIONS} AS "customDimensions",
    NULL::VARCHAR AS "geoNetwork",
    '{{"source": "' || event_type || '"}}' AS "trafficSource",
    {_RAW_TEXTS}
  FROM hits
)
SELECT * REPLACE (
  nullif("channelGrouping", '({SENTINEL})') AS "channelGrouping",
  CASE WHEN "fullVisitorId" LIKE '%{SENTINEL}%' THEN NULL
       ELSE "fullVisitorId" END AS "fullVisitorId")
FROM raw
"""

_DATE_DIMENSION = """
  SELECT d AS "date", year(d)::INTEGER AS "year", month(d)::INTEGER AS "month",
         day(d)::INTEGER AS "day", strftime(d, '%A') AS weekday
  FROM (SELECT try_strptime("date", '%Y%m%d')::DATE AS d FROM (SELECT DISTINCT "date" FROM kpi))
"""

_PROFILED = ["fullVisitorId", "visitId", "visitNumber", "date", "visitStartTime",
             "channelGrouping", "socialEngagementType", "device", "customDimensions",
             "geoNetwork", "trafficSource", "totals", "hits"]
_RAW_NULLS = {"fullVisitorId": "k = '7'", "visitId": "k = '13'", "visitNumber": "k IS NULL",
              "date": "k = '52'", "visitStartTime": "ts IS NULL",
              "device": "k IS NULL", "trafficSource": "event_type IS NULL",
              "customDimensions": "event_type IS NULL AND k NOT IN ('63','64','65')",
              "totals": "k = '31'", "hits": "k = '43'"}


def _raw_null(name: str) -> str:
    return _RAW_NULLS.get(name, "false")


def _export(name: str, columns: list[str], rows: str) -> str:
    """The rows of a table as text, its columns in order."""
    cells = ", ".join(f"coalesce(({column})::VARCHAR, '-')" for column in columns)
    return f"""
        SELECT '{name}' AS export, concat_ws('|', {cells}) AS row FROM ({rows})"""


FIRST_HITS = f"""
    WITH {_EVENTS}
    SELECT CASE k WHEN '13' THEN NULL ELSE event_id::VARCHAR END AS "visitId", {_hit(_BAD_HITS)}
    FROM ev"""

STAR_ROWS = over_kpi(" UNION ALL ".join([
    _export("hechos_visitas", [
        '"visitId"', '"fullVisitorId"', '"date"', '"visitNumber"', '"visitStartTime"',
        "visits", "pageviews", "transactions", 'round("transactionRevenue" * 100)::BIGINT',
        '"channelGrouping"', '"hitType"'], "SELECT * FROM kpi"),
    _export("dim_tiempo", ['"date"', '"year"', '"month"', '"day"', "weekday"],
            _DATE_DIMENSION),
    _export("dim_visitante", ['"fullVisitorId"', '"socialEngagementType"'],
            'SELECT DISTINCT "fullVisitorId", "socialEngagementType" FROM kpi'),
    _export("dim_canal", ['"channelGrouping"'], 'SELECT DISTINCT "channelGrouping" FROM kpi'),
    _export("dim_pagina", ['"pagePath"', "referer", '"isInteraction"'],
            'SELECT DISTINCT "pagePath", referer, "isInteraction" FROM kpi'),
]))

EVENT_SUMS = over_kpi("""
    SELECT true AS names_match, true AS stamps_fit, true AS time_passed,
           1::BIGINT AS runs, true AS every_batch_complete, 0::BIGINT AS errors,
           (SELECT count(*) FROM raw)::BIGINT AS filas_originales,
           (SELECT count(*) FROM kpi)::BIGINT AS filas_finales,
           (SELECT count(*) FROM ev WHERE k = '7')::BIGINT AS null_visitors""")

# Visits with odd numbers come in a lot without totals.
MIXED_LOTS = f"""
    SELECT * EXCLUDE (even) REPLACE (
      CASE WHEN even THEN visits END AS visits,
      CASE WHEN even THEN pageviews END AS pageviews,
      CASE WHEN even THEN transactions END AS transactions,
      CASE WHEN even THEN "transactionRevenue" END AS "transactionRevenue")
    FROM (SELECT *, "visitId"::BIGINT % 2 = 0 AS even FROM ({KPI_ROWS}))"""

ORACLE = {
    # Files
    "csv_multiline_roundtrip": """
        SELECT doc_id::VARCHAR AS doc_id, text, lang, source, n_chars::VARCHAR AS n_chars
        FROM documents
        UNION ALL SELECT NULL, NULL, CASE WHEN lang <> 'en' THEN lang END, NULL, NULL
        FROM documents""",
    "csv_header_order": """
        SELECT page_id::VARCHAR AS page_id, url, CASE WHEN page_id % 2 = 0 THEN html END AS html
        FROM pages""",
    "csv_wide_roundtrip": "SELECT page_id::VARCHAR AS page_id, url, html FROM pages",
    "csv_split_scan": """
        SELECT doc_id::VARCHAR AS doc_id, text, lang, source, n_chars::VARCHAR AS n_chars
        FROM documents""",
    "chunked_export": """
        WITH numbered AS (
          SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders)
        SELECT (i // 5000)::BIGINT AS chunk, 1::BIGINT AS files, (i % 5000)::BIGINT AS place,
               o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey,
               o_orderstatus, o_totalprice::VARCHAR AS o_totalprice,
               strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
        FROM numbered""",
    "parquet_accumulate": """
        SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate) FROM orders""",
    "single_file_export": "SELECT *, 1::INTEGER AS files FROM customer",
    # Scalar functions
    "json_map_normalize": """
        SELECT event_id, '{"k":"' || json_extract_string(props, '$.k') || '"}' AS device
        FROM events""",
    "json_array_map_normalize": """
        SELECT event_id, '[{"k":"' || json_extract_string(props, '$.k') || '"}]'
               AS "customDimensions" FROM events""",
    "sentinel_to_null": f"""
        WITH {_EVENTS}
        SELECT event_id::VARCHAR AS event_id,
               CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS channel
        FROM ev""",
    "lenient_casts": """
        SELECT event_id, trunc(value)::INTEGER AS whole, value AS number,
               NULL::INTEGER AS bad FROM events""",
    "date_parts": """
        SELECT o_orderkey, o_orderdate::DATE AS "date",
               year(o_orderdate)::INTEGER AS "year", month(o_orderdate)::INTEGER AS "month",
               day(o_orderdate)::INTEGER AS "day", strftime(o_orderdate, '%A') AS weekday
        FROM orders""",
    "first_hit_literal": FIRST_HITS,
    "first_hit_builtin": FIRST_HITS,
    "first_hit_json": """
        WITH ev AS (SELECT *, json_extract_string(props, '$.k') AS k FROM events)
        SELECT event_id::VARCHAR AS "visitId",
               CASE WHEN k IN ('40','42','43') OR k IS NULL THEN NULL
                    ELSE upper(event_type) END AS "hitType",
               CASE WHEN k NOT IN ('40','42','43','45','46')
                    THEN '/' || event_type || '/' || k END AS "pagePath",
               CASE WHEN k NOT IN ('40','42','43','45','46')
                    THEN CASE WHEN event_type = 'view' THEN 'false' ELSE 'true' END
                    END AS "isInteraction",
               NULL::VARCHAR AS referer
        FROM ev""",
    # Projections and filters over raw visits
    "allow_list_projection": f"""
        WITH {_EVENTS}, raw AS (SELECT {_RAW_COLUMNS} 1 AS one FROM ev)
        SELECT "fullVisitorId", "visitId", "visitNumber", "date", "visitStartTime",
               "channelGrouping", "socialEngagementType" FROM raw""",
    "totals_flatten": f"""
        WITH {_EVENTS}
        SELECT CASE k WHEN '13' THEN NULL ELSE event_id::VARCHAR END AS "visitId",
               {_metrics(_BAD_TOTALS)} FROM ev""",
    "drop_null_keys": f"""
        WITH {_EVENTS}, raw AS (SELECT {_RAW_COLUMNS} 1 AS one FROM ev)
        SELECT "fullVisitorId", "visitId" FROM raw
        WHERE "fullVisitorId" IS NOT NULL AND "visitId" IS NOT NULL""",
    "raw_clean": CLEAN_RAW,
    # An empty text does not survive CSV: it is read as NULL.
    "raw_ingest_job": f"""
        SELECT * REPLACE (nullif("fullVisitorId", '') AS "fullVisitorId",
                          nullif(hits, '') AS hits), 3::INTEGER AS files
        FROM ({CLEAN_RAW})""",
    "raw_ingest_splits": f"""
        SELECT * REPLACE (nullif("fullVisitorId", '') AS "fullVisitorId", nullif(hits, '') AS hits)
        FROM ({CLEAN_RAW})""",
    # Visit KPI
    "visit_kpi": KPI_ROWS,
    "visit_kpi_typed_totals": """
        SELECT event_id::VARCHAR AS "visitId", 1::INTEGER AS visits,
               CASE WHEN event_type = 'view' THEN trunc(value) END::INTEGER AS pageviews,
               NULL::INTEGER AS transactions, value AS "transactionRevenue",
               'PAGE' AS "hitType"
        FROM events""",
    "visit_kpi_rebuild": KPI_ROWS,
    "kpi_mixed_schemas": MIXED_LOTS,
    "kpi_incremental_schemas": MIXED_LOTS,
    "monitored_mixed_lots": MIXED_LOTS,
    # A row without a visitor id comes back from CSV as one without a visitor.
    "session_settings": over_kpi("""
        SELECT metric, count(*) FILTER ("fullVisitorId" <> '') AS value
        FROM kpi, (VALUES ('kpi'), ('kpi2')) jobs(metric) GROUP BY metric
        UNION ALL SELECT 'changed settings', 0"""),
    "visit_kpi_microbatch": KPI_ROWS,
    "monitored_rebuild": KPI_ROWS,
    "batch_error_mixed": over_kpi("""
        SELECT 'inicio_lote' AS metric, 1::BIGINT AS value
        UNION ALL SELECT 'error', 1
        UNION ALL SELECT 'failed files', 1
        UNION ALL SELECT 'kpi rows', count(*) FROM kpi"""),
    # Profiles and events
    "row_count": "SELECT count(*)::BIGINT AS rows FROM events",
    "column_null_profile": f"WITH {_EVENTS} " + " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*)::BIGINT AS rows, "
        f"(count(*) FILTER ({_raw_null(name)}))::BIGINT AS nulls FROM ev"
        for name in _PROFILED),
    "rows_where_null": f"""
        WITH {_EVENTS}
        SELECT event_id::VARCHAR AS "visitId" FROM ev WHERE k = '7'""",
    "batch_events": EVENT_SUMS,
    "append_events": EVENT_SUMS,
    "batch_error_isolation": over_kpi("""
        SELECT 'failed lot' AS metric, 2::BIGINT AS value
        UNION ALL SELECT 'failed files', 1::BIGINT
        UNION ALL SELECT 'kpi rows', 2 * count(*) FROM kpi"""),
    "event_stream_decode": """
        SELECT * REPLACE (strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts), NULL::VARCHAR AS texto
        FROM events
        UNION ALL BY NAME SELECT '{broken ' || event_id AS texto
        FROM events WHERE event_id % 10 = 0""",
    # Star schema
    "union_lots": KPI_ROWS,
    "fact_visits": over_kpi("""
        SELECT "visitId", "fullVisitorId", "date", "visitNumber", "visitStartTime", visits,
               pageviews, transactions, "transactionRevenue", "channelGrouping", "hitType"
        FROM kpi"""),
    "dim_date": over_kpi(_DATE_DIMENSION),
    "dim_visitor": over_kpi('SELECT DISTINCT "fullVisitorId", "socialEngagementType" FROM kpi'),
    "dim_channel": over_kpi('SELECT DISTINCT "channelGrouping" FROM kpi'),
    "dim_page": over_kpi("""
        SELECT DISTINCT "pagePath" AS url_pagina, referer AS pagina_referida, "isInteraction"
        FROM kpi"""),
    "star_counts": over_kpi("""
        SELECT 'kpi_total_unificado' AS table_name, count(*)::BIGINT AS rows FROM kpi
        UNION ALL SELECT 'hechos_visitas', count(*) FROM kpi
        UNION ALL SELECT 'dim_tiempo', count(*) FROM (SELECT DISTINCT "date" FROM kpi)
        UNION ALL SELECT 'dim_visitante', count(*)
          FROM (SELECT DISTINCT "fullVisitorId", "socialEngagementType" FROM kpi)
        UNION ALL SELECT 'dim_canal', count(*) FROM (SELECT DISTINCT "channelGrouping" FROM kpi)
        UNION ALL SELECT 'dim_pagina', count(*)
          FROM (SELECT DISTINCT "pagePath", referer, "isInteraction" FROM kpi)"""),
    "star_exports": STAR_ROWS,
    "star_incremental": STAR_ROWS,
}
