import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from footfall.llm import negatives
from footfall.llm.oracle import ORACLE
from footfall.llm.queries import QUERIES

duckdb = pytest.importorskip("duckdb")


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 5), st.integers(0, 7), st.sampled_from([1, 256, 1 << 20, 1 << 29]), st.randoms())
def test_packed_products_are_exact(length, n, most, rng):
    rows = [[rng.randint(-most, most) for _ in range(length)] for _ in range(n)]
    anchors = [[rng.choice([-most, most, 0, rng.randint(-most, most)]) for _ in range(length)] for _ in range(3)]
    block = negatives.PackedBlock(np.array(rows, dtype=np.int64).reshape(n, length),
                                  max(sum(map(abs, a)) for a in anchors))
    for anchor in anchors:
        assert block.scores(anchor).tolist() == [sum(x * y for x, y in zip(anchor, row)) for row in rows]


def brute(rows, is_anchor, n_positives=5, n_negatives=5, percent=80, scale=256):
    points = []
    for id_, label, vector in rows:
        if id_ is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(scale * x) for x in vector]
        if len(whole) * max((abs(x) for x in whole), default=0) ** 2 < 1 << 62:
            points.append((id_, label, whole))
    out = []
    for anchor, label, vector in points:
        if not is_anchor(anchor):
            continue
        scored = sorted(((-sum(x * y for x, y in zip(vector, other)), id_, own == label)
                         for id_, own, other in points if id_ != anchor and len(other) == len(vector)),
                        key=lambda row: row[:2])
        for k, (minus, positive, _) in enumerate([row for row in scored if row[2]][:n_positives], 1):
            near = [row for row in scored if not row[2] and percent * -minus <= 100 * -row[0] <= 100 * -minus]
            out += [(anchor, positive, rank, id_, -minus, -s, k) for rank, (s, id_, _) in enumerate(near[:n_negatives], 1)]
    return sorted(out)


def mined(df, **options):
    out = negatives.mine_hard_negatives(df, F.col("vec_id") % 5 == 0, **options)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score",
                           "positive_rank"]
    return sorted(map(tuple, out.collect()))


SCHEMA = "vec_id long, label int, embedding array<float>, id string, `a.b` int, data int"


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, monkeypatch, seed):
    random.seed(seed)
    monkeypatch.setattr(negatives, "BLOCK_BYTES", 600)  # few rows a block, few anchors a tile
    monkeypatch.setattr(negatives, "ANCHOR_BYTES", 300)
    rows = []
    for i in range(150):
        length = random.choice([4, 4, 4, 3])
        vector = [random.choice([0.5, 1.0, random.uniform(-0.2, 1)]) for _ in range(length)]
        rows.append((i, random.randint(0, 3), vector))
    rows += random.sample(rows, 20)  # repeated rows, ties
    rows += [(15, 2, [1.0, 0.0, 0.5, 0.5]), (300, None, [1.0] * 4), (305, 1, None), (310, 1, [1.0, None, 0.0, 1.0]),
             (315, 1, [float("nan")] * 4), (320, 1, [float("inf")] * 4), (325, 1, []), (330, 2, []), (335, 1, [3e38] * 4),
             (340, 1, [1e6, -1e6, 0.0, 0.0]), (341, 1, [9e5, -1e6, 0.0, 0.0]), (342, 2, [9e5, -9e5, 0.0, 0.0]),
             (None, 1, [1.0] * 4), (345, 9, [1.0] * 4)]
    random.shuffle(rows)
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(4)
    assert mined(df) == brute(rows, lambda i: i % 5 == 0)
    assert mined(df, n_positives=2, n_negatives=3, least_percent=50) == brute(
        rows, lambda i: i % 5 == 0, 2, 3, 50)


def test_empty_table_and_no_anchors(spark):
    df = spark.createDataFrame([(1, 1, [1.0], "x", 1, 2)], SCHEMA)
    assert mined(df) == [] and mined(df.limit(0)) == []


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    want = duckdb.sql(ORACLE["op11_hard_negatives"])
    found = QUERIES["op11_hard_negatives"](spark, sf_dir)
    assert sorted(found.columns) == sorted(want.columns)
    rows = sorted(map(tuple, found.select(want.columns).collect()))
    assert rows == sorted(want.fetchall()) and rows
