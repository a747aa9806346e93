import ast
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from footfall.functions import first_hit, with_first_hit
from footfall.functions.hits import (
    _first_hit_of_plain, _parse_literal, _respell_as_json, first_hit_of_literal,
)

NONE = (None, None, None, None)

LITERAL_CASES = [
    (None, NONE),
    ("", NONE),
    ("[]", NONE),
    ("5", NONE),
    ("not a literal", NONE),
    ("{'type': 'PAGE'}", ("PAGE", None, None, None)),
    ("[{'type': 'A'}, {'type': 'B'}]", ("A", None, None, None)),
    ("[{'type': 'A', 'page': None}]", NONE),
    ("[{'type': 'A', 'page': 'x'}]", NONE),
    ("['A']", NONE),
    ("[[]]", NONE),
    ("({'type': 'A'},)", NONE),
    ("[{'type': 'A', 'isInteraction': True}]", ("A", None, "true", None)),
    ("[{'type': 'A', 'isInteraction': False}]", ("A", None, "false", None)),
    ('[{"type":"A","isInteraction":true}]', NONE),
    ('[{"type":"A","isInteraction":True}]', ("A", None, "true", None)),
    ("[{'type': 'A', 'referer': null}]", NONE),
    ("[{'type': 'A', 'isInteraction': 1, 'referer': -7}]", ("A", None, "1", "-7")),
    ("[{'type': 1.5, 'referer': 1e10}]", ("1.5", None, None, "1.0E10")),
    ("[{'type': 'A'}, oops]", NONE),
    ("[{'type': 'A'}] trailing", NONE),
    ("[{'type': 'it\\'s', 'page': {'pagePath': \"/men's\"}}]", ("it's", "/men's", None, None)),
    ("[{'type': 'say \"hi\"', 'referer': \"it's\"}]", ('say "hi"', None, None, "it's")),
    ("[{'type': 'A' 'B'}]", ("AB", None, None, None)),
    ("[{'type': '''A'''}]", ("A", None, None, None)),
    ("[{'type': 'True None', 'referer': None}]", ("True None", None, None, None)),
    ("[{'page': {'pagePath': '/p', 'x': [1, {'y': 2}]}, 'type': 'A', 'type': 'B'}]",
     ("B", "/p", None, None)),
    ("  [{'type': 'A'}]", ("A", None, None, None)),
    ("[{'type': 'é', 'referer': '\t'}]", ("é", None, None, "\t")),
    ("[" * 300 + "]" * 300, NONE),
]


@pytest.mark.parametrize("text, expected", LITERAL_CASES)
def test_first_hit_of_a_literal(text, expected):
    assert first_hit_of_literal(text) == expected


def test_literal_dialect_in_spark(spark):
    texts = [text for text, _ in LITERAL_CASES]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, hits string").repartition(3)
    rows = df.select("i", first_hit(F.col("hits")).alias("h")).select("i", "h.*").orderBy("i")
    assert [tuple(row)[1:] for row in rows.collect()] == [want for _, want in LITERAL_CASES]


def test_literal_dialect_on_no_rows(spark):
    df = spark.createDataFrame([], "hits string")
    assert df.select(first_hit(F.col("hits"))).collect() == []


def test_json_dialect(spark):
    cases = [
        ('[{"type":"A","isInteraction":true}]', ("A", None, "true", None)),
        ('{"type":"A","page":{"pagePath":"/p"},"referer":"r"}', ("A", "/p", None, "r")),
        ('[{"type":"A","page":null}]', ("A", None, None, None)),
        ('[{"type":"A"},{"type":"B"}]', ("A", None, None, None)),
        ("[]", NONE), ("bad", NONE), (None, NONE),
    ]
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(cases)], "i int, h string")
    rows = df.select("i", first_hit(F.col("h"), "json").alias("h")).select("i", "h.*").orderBy("i")
    assert [tuple(row)[1:] for row in rows.collect()] == [want for _, want in cases]


def test_unknown_dialect():
    with pytest.raises(ValueError, match="dialect"):
        first_hit(F.lit("x"), "yaml")


def same_outcome(text):
    def outcome(parse):
        try:
            return repr(parse(text))
        except Exception:
            return "error"
    assert outcome(_parse_literal) == outcome(ast.literal_eval)


scalars = st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False) | st.text()
values = st.recursive(
    scalars, lambda inner: st.lists(inner, max_size=4)
    | st.dictionaries(st.text(max_size=5), inner, max_size=4), max_leaves=12)


@settings(max_examples=300, deadline=None)
@given(st.lists(values, min_size=1, max_size=3))
def test_written_literals_parse_the_same(value):
    same_outcome(repr(value))


pieces = st.sampled_from([
    "[", "]", "{", "}", ":", ",", " ", "'", '"', "'a'", '"b"', "'it\"s'", '"it\'s"', "''", '""',
    "True", "False", "None", "true", "null", "NaN", "Infinity", "1", "-2", "+3", "05", "1.50",
    ".5", "2.", "1e5", "1_0", "b", "\\", "\\n", "\n", "\t", "#", "(", ")", "'k': ", "\0", "é"])


@settings(max_examples=2000, deadline=None)
@given(st.lists(pieces, max_size=10), st.sampled_from(["[%s]", "{%s}", "[{'k': %s}]", "%s"]))
def test_scrambled_literals_parse_the_same(parts, frame):
    text = frame % "".join(parts)
    if text:
        same_outcome(text)


def test_usual_hits_take_the_fast_way():
    hit = {"type": "PAGE", "page": {"pagePath": "/men's"}, "isInteraction": True, "time": 1.5}
    assert _respell_as_json(repr([hit, hit])) is not None
    assert _respell_as_json("[{'a': True}]") == '[{"a": true}]'
    long_visit = repr([hit] * 500)
    assert _respell_as_json(long_visit) is not None
    assert _respell_as_json("[" * 150 + "]" * 150) is None


def both_ways(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, hits string").repartition(3)
    found = with_first_hit(df.withColumn("plain", _first_hit_of_plain(F.col("hits"))), "hits", "h")
    return {r.i: r for r in found.select("i", "h.*", F.col("plain").isNotNull().alias("fast")).collect()}


def test_plain_literals_need_no_python(spark):
    texts = [text for text, _ in LITERAL_CASES]
    rows = both_ways(spark, texts)
    assert [tuple(rows[i])[1:5] for i in range(len(texts))] == [want for _, want in LITERAL_CASES]
    hit = {"type": "PAGE", "page": {"pagePath": "/men"}, "isInteraction": True, "time": 1.5, "x": [None, {}]}
    fast = [repr([hit]), repr(hit), repr([hit] * 300), "[]", "['A']", "[{'type': 'A', 'page': None}]", repr([hit, 7])]
    slow = [repr([{**hit, "type": "it's"}]), "[{'type': 1.5}]", "[{'type': {'a': 1}}]", "[{'a': 1}, {1}]", "[{'type': true}]",
            "[" * 150 + "]" * 150, "[{'type': 'A', 'type': 'B'}]", "({},)", None, "[{'type': 'A'}][]", "[{'type': 'A'}], [1]", "[{'type': 'A'}]},{",
            "{'type': 'A'}, 'hits': {'type': 'B'}", "[{'type': 'A', 'referer': 'it is True'}]", "[{'type': 'A'}] x"]
    rows = both_ways(spark, fast + slow)
    assert [rows[i].fast for i in range(len(rows))] == [True] * len(fast) + [False] * len(slow)
    assert all(tuple(rows[i])[1:5] == first_hit_of_literal(text) for i, text in enumerate(fast + slow))


def test_both_ways_agree_on_scrambled_literals(spark):
    random.seed(4)
    parts = ["[", "]", "{", "}", ":", ",", " ", "'", '"', "'a'", '"b"', "''", "True", "False", "None", "true", "null",
             "NaN", "Infinity", "1", "-2", "+3", "05", "1.50", "-0", ".5", "2.", "1e5", "1_0", "1" * 25, "b", "\\", "\n", "\t",
             "\f", "#", "(", "'k': ", "'type': ", "'page': ", "'pagePath': ", "{'pagePath': 'p'}", "'referer': ", "\0",
             "é", "\u2028", "True'", "'x': [1, {}], "]
    frames = ["[%s]", "{%s}", "[{'type': %s}]", "[{'type': 'A', 'page': %s}]", "[{'page': {'pagePath': %s}}, %s]", "%s",
              "{'referer': %s, 'isInteraction': %s}"]
    texts = []
    for _ in range(4000):
        frame = random.choice(frames)
        texts.append(frame % tuple("".join(random.choices(parts, k=random.choice([0, 1, 1, 1, 2, 3, 5])))
                                   for _ in range(frame.count("%s"))))
    rows = both_ways(spark, texts)
    for i, text in enumerate(texts):
        assert tuple(rows[i])[1:5] == first_hit_of_literal(text), text
    assert sum(rows[i].fast for i in rows) > 200
