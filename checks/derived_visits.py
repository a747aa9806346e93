"""Raw visit exports derived from the ``events`` table, one visit per event.

The test data has no visits, so each event is rewritten as one row of a raw export, all
columns text.  It is a plain projection: no shuffle, and every event is there whole.  The
small number ``k`` in an event's ``props`` decides which kind of damage its visit shows
(see FIXTURES.md, section 3); ``checks/oracle.py`` states what must come out.
"""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.contract import PLACEHOLDER
from footfall.scratch import new_folder

# Batches the streaming checks aim at, whatever the size of the data.
LOTS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and their ``k``."""
    return table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k"))


# Below, columns are built as SQL text: so many small expressions are faster to parse at
# once than to build one by one.


def _quoted(text: str | None) -> str:
    if text is None:
        return "CAST(NULL AS STRING)"
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _text(template: str) -> str:
    """SQL for a text whose ``<name>`` parts stand for columns."""
    parts = re.split(r"<(\w+)>", template)
    return " || ".join(part if i % 2 else _quoted(part)
                       for i, part in enumerate(parts) if part)


def _by_k(cases: dict, otherwise: str) -> str:
    """SQL that chooses by ``k``, comparing ``props`` as text instead of parsing its JSON."""
    whens = " ".join(f"WHEN {_quoted(f'{{"k": {k}}}')} THEN {sql}" for k, sql in cases.items())
    return f"CASE props {whens} ELSE {otherwise} END"


def _by_type(cases: dict, otherwise: str) -> str:
    whens = " ".join(f"WHEN {_quoted(kind)} THEN {sql}" for kind, sql in cases.items())
    return f"(CASE event_type {whens} ELSE {otherwise} END)"


def _totals() -> str:
    more = _by_type({
        "view": _text(', "pageviews": "<k>"'),
        "purchase": _text(', "transactions": "1", "transactionRevenue": "<value>"'),
    }, "''")
    usual = " || ".join([_quoted('{"visits": "1"'), more, _quoted(', "bounces": {"n": 1}}')])
    return _by_k({
        30: _quoted("{broken"),
        31: _quoted(None),
        32: _quoted('{"visits":1,"pageviews":2}'),
        33: _quoted('{"visits": "2.5", "pageviews": "99999999999", "transactions": "x", '
                    '"transactionRevenue": "1e3"}'),
        34: _quoted('{"VISITS": "1"}'),
        35: _quoted('{"visits": "1", "note": "' + PLACEHOLDER + '"}'),
    }, usual)


def _literal_hits() -> str:
    ends = "'isInteraction': <interaction>, 'referer': <ref>}"
    first = ("{'hitNumber': 1, 'type': '<kind>', 'page': {'pagePath': '/<event_type>/<k>', "
             "'hostname': 'shop.example'}, " + ends)
    second = "{'hitNumber': 2, 'type': 'EXIT', 'page': {'pagePath': '/exit'}, 'time': 12.50}"
    quoted = ("[{'type': '<kind>', 'page': {'pagePath': \"/<event_type>/<k>/it's\"}, "
              + ends + ", " + second + "]")
    return _by_k({
        40: _quoted("oops("),
        41: _quoted(""),
        42: _quoted("[]"),
        43: _quoted(None),
        44: _text(first),
        45: _text("[{'type': '<kind>', 'page': None}]"),
        46: _text("[{'type': '<kind>'}]"),
        47: _text('[{"type": "<kind>", "isInteraction": true, "referer": null}]'),
        48: _text("[" + first + ", {'type': '" + PLACEHOLDER + "'}]"),
        49: _quoted("['A']"),
    }, f"CASE WHEN k LIKE '9_' THEN {_text(quoted)} ELSE {_text(f'[{first}, {second}]')} END")


def raw_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw export, 13 text columns."""
    parts = _events(spark, sf_dir).selectExpr(
        "*",
        "upper(event_type) AS kind",
        _by_type({"view": "'False'"}, "'True'") + " AS interaction",
        _by_type({"click": _text("'https://ref.example/<k>'")}, "'None'") + " AS ref",
    )
    columns = {
        "fullVisitorId": _by_k({7: _quoted(None), 21: _quoted(f"user {PLACEHOLDER}"), 22: "''"},
                               "CAST(user_id AS STRING)"),
        "visitId": _by_k({13: _quoted(None)}, "CAST(event_id AS STRING)"),
        "visitNumber": "k",
        "date": _by_k({50: "'not-a-date'", 51: "'20240230'", 52: _quoted(None)},
                      "date_format(ts, 'yyyyMMdd')"),
        "visitStartTime": "CAST(timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) AS STRING)",
        "channelGrouping": _by_type({
            "signup": "'Direct'", "click": "'Organic Search'", "view": "'Referral'",
            "purchase": "'Social'"}, _quoted(f"({PLACEHOLDER})")),
        "socialEngagementType": _by_type({"signup": "'Socially Engaged'"},
                                         "'Not Socially Engaged'"),
        "device": _by_k({60: "'not json'", 61: _quoted('[{"a":1}]'),
                         62: _quoted('{"browser": "' + PLACEHOLDER + '"}')},
                        _text('{"browser": "chrome", "info": {"k": <k>}}')),
        "customDimensions": _by_k({63: "'[]'", 64: _quoted('{"index": "4"}'), 65: "'bad'"},
                                  _text('[{"index": 4, "value": "<event_type>"}]')),
        "geoNetwork": _quoted('{"city": "' + PLACEHOLDER + '"}'),
        "trafficSource": _text('{"source": "<event_type>"}'),
        "totals": _totals(),
        "hits": _literal_hits(),
    }
    return parts.selectExpr(*(f"{sql} AS {name}" for name, sql in columns.items()))


def raw_visits_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``visitId`` and ``hits``, the latter written as true JSON."""
    parts = _events(spark, sf_dir).selectExpr(
        "*",
        "upper(event_type) AS kind",
        _by_type({"view": "'false'"}, "'true'") + " AS interaction",
    )
    hits = _by_k({
        40: _quoted("oops("),
        42: _quoted("[]"),
        43: _quoted(None),
        45: _text('[{"type": "<kind>", "page": null}]'),
        46: _text('{"type": "<kind>"}'),
    }, _text('[{"type": "<kind>", "page": {"pagePath": "/<event_type>/<k>"}, '
             '"isInteraction": <interaction>, "referer": null}, {"type": "EXIT"}]'))
    return parts.selectExpr("CAST(event_id AS STRING) AS visitId", f"{hits} AS hits")


def write_lot(visits: DataFrame, folder: str) -> int:
    """Append visits to a folder; returns how many files the folder then holds."""
    visits.write.mode("append").parquet(folder)
    return len(visits.sparkSession.read.parquet(folder).inputFiles())


def raw_lots(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """Write the raw visits to a folder; its path, and the files per batch for LOTS batches."""
    folder = new_folder(spark, "raw-lots")
    files = write_lot(raw_visits(spark, sf_dir), folder)
    return folder, -(-files // LOTS)
