import math
import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from footfall.llm import quality
from footfall.llm.quality import cut_of, learn, logits, meta_features, score_quality, text_features


def rows(n, seed):
    random.seed(seed)
    out = []
    for i in range(n):
        good = random.random() < 0.7
        words = random.choices([f"w{k}" for k in range(200)], k=random.randint(20, 120))
        if not good:
            for _ in range(max(2, len(words) // 15)):
                words[random.randrange(len(words))] = random.choice(["junk!!", "|", "spammy"])
        source = "clean" if good == (random.random() < 0.85) else "dirty"
        out.append((i, " ".join(words), source, len(words), int(good)))
    return out


@pytest.fixture(scope="module")
def fitted(spark):
    data = rows(1200, 1)
    docs = spark.createDataFrame([r[:4] for r in data], "doc_id long, text string, source string, n long")
    labels = [(r[0], r[4]) for r in data[:500]] + [(3, 1 - data[3][4]), (None, 1), (5, None)]
    return learn(docs, spark.createDataFrame(labels, "doc_id long, good int"), ["source", "n"])


def test_held_out_accuracy_and_calibration(spark, fitted):
    data = rows(600, 2)
    docs = spark.createDataFrame([r[:4] for r in data], "doc_id long, text string, source string, n long")
    got = {r.doc_id: r for r in score_quality(docs, fitted, ["source", "n"]).collect()}
    good = np.array([r[4] for r in data])
    score = np.array([got[i].score for i in range(len(data))])
    assert ((score >= 0.5) == good).mean() > 0.95
    assert abs(score.mean() - good.mean()) < 0.08
    meta = np.array([got[i].meta_score for i in range(len(data))])
    assert meta[good == 1].mean() > meta[good == 0].mean() + 0.2


def test_nulls_long_texts_repeated_rows_and_clashing_names(spark, fitted):
    docs = spark.createDataFrame(
        [(1, None, None, None, 1), (2, "", "", 0, 1), (3, "spammy " * 40_000, "dirty", 40_000, 1)] * 2,
        "doc_id long, text string, source string, n long, _text int")
    out = score_quality(docs, fitted, ["source", "n"])
    assert out.columns == ["doc_id", "text", "source", "n", "_text", "score", "text_score", "meta_score"]
    got = out.collect()
    assert all(0 <= r.score <= 1 for r in got) and got[0] == got[3] and got[2].score < 0.5
    assert score_quality(docs.limit(0), fitted, ["source", "n"]).count() == 0


def test_learning_from_nothing(spark):
    docs = spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string")
    model = learn(docs, spark.createDataFrame([], "doc_id long, good int"), ["source"])
    assert score_quality(docs, model, ["source"]).first().score == 0.5


def test_logits_are_the_products():
    features = text_features([b"a b a", b"", None, b"c"])
    weights = np.random.default_rng(0).normal(size=1 << 15)
    first, places, values = features
    want = [sum(weights[p] * v for p, v in zip(places[a:b], values[a:b], strict=True))
            for a, b in zip(first[:-1], first[1:], strict=True)]
    assert np.allclose(logits(features, weights), want)


def test_every_unlabelled_row_can_teach(spark):
    """A source only in unlabelled rows beyond the first 4000 by hash gets a weight."""
    data = rows(10_000, 5)
    docs = spark.createDataFrame([(r[0], r[1], r[2], 1) for r in data],
                                 "doc_id long, text string, source string, n long")
    place = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) / (1 << 30)
    far = (place > 4000 / 9500) & (F.col("doc_id") >= 500) & F.col("text").contains("junk!!")
    docs = docs.withColumn("source", F.when(far, "odd").otherwise(F.col("source")))
    labels = spark.createDataFrame([(r[0], r[4]) for r in data[:500]], "doc_id long, good int")
    model = learn(docs, labels, ["source", "n"])
    odd = meta_features([["odd"], [1]])[1][1]
    assert model.meta[odd] < -0.1


def test_cuts_take_as_many_as_asked():
    counts = np.array([3, 0, 4, 10, 0, 5])
    assert cut_of(counts, 5, 7) == (2, 0.5, 3, 0.2)
    assert cut_of(counts, 0, 0) == (0, 0.0, 5, 0.0)
    assert cut_of(counts, 99, 99) == (6, 0.0, -1, 0.0)


def plain_view(rng, n, width):
    """Rows as lists of (place, value), and the same packed."""
    rows = [[(int(p), float(np.float32(v))) for p, v in zip(rng.choice(width, 6, replace=False), rng.normal(0, 2, 6))]
            for _ in range(n)]
    first = np.arange(n + 1) * 6
    flat = [entry for row in rows for entry in row]
    return rows, (first, np.array([p for p, _ in flat]), np.array([v for _, v in flat], dtype=np.float32))


def test_one_round_of_exchange_equals_plain_loops():
    rng = np.random.default_rng(5)
    n, width, n_low, n_high = 80, 40, 13, 17
    both = [plain_view(rng, n, width) for _ in range(2)]
    weights = [rng.normal(0, 1.5, width) for _ in range(2)]
    luck = rng.random(n)
    scores = [[sum(weights[v][p] * x for p, x in row) for row in both[v][0]] for v in range(2)]
    for v in range(2):
        assert np.allclose(quality.logits(both[v][1], weights[v]), scores[v])
    step = (quality.BINS - 1) / (2 * quality.FARTHEST)
    bins = [[int((min(max(s, -quality.FARTHEST), quality.FARTHEST) + quality.FARTHEST) * step) for s in own] for own in scores]
    cuts = [quality.cut_of(np.bincount(own, minlength=quality.BINS), n_low, n_high) for own in bins]
    found = quality._named((both[0][1], both[1][1]), luck, [(weights, cuts)])
    sure = math.log(quality.SURE / (1 - quality.SURE))
    for v in range(2):
        want = []
        for i in range(n):
            # of the rows with the same score a share is taken, which luck draws
            below = sum(b < bins[v][i] for b in bins[v])
            equal = sum(b == bins[v][i] for b in bins[v])
            above = n - below - equal
            bad, good = (luck[i] < min(max((most - less) / equal, 0), 1) for most, less in ((n_low, below), (n_high, above)))
            want.append(1 if good and scores[v][i] >= sure else 0 if bad and scores[v][i] <= -sure else -1)
        assert found[1 - v].tolist() == want and {0, 1} <= set(want)
    # what is named already keeps its name
    again = quality._named((both[0][1], both[1][1]), luck, [(weights, cuts), ([-w for w in weights], cuts)])
    assert all((b == a)[a >= 0].all() for a, b in zip(found, again))


def test_losses_and_slopes_equal_plain_loops():
    rng = np.random.default_rng(6)
    rows, packed = plain_view(rng, 30, 20)
    weights, y = rng.normal(0, 1, 20), (rng.random(30) < 0.3).astype(float)
    importance = quality._importance((y == 0).sum(), (y == 1).sum())
    loss, slope = 0.0, [0.0] * 20
    for row, label in zip(rows, y):
        weight = 0.5 / (sum(y == label) / 30) / 30
        p = 1 / (1 + math.exp(-sum(weights[at] * x for at, x in row)))
        loss -= weight * math.log(p if label else 1 - p)
        for at, x in row:
            slope[at] += weight * (p - label) * x
    assert np.allclose(quality.loss_and_slope(packed, y, importance, weights), [loss, *slope])


def test_equal_scores_are_named_by_luck(spark):
    """Ties: all rows alike; of each class about its share is named, and a repeated row as the first."""
    counts = np.zeros(quality.BINS, dtype=np.int64)
    counts[100] = 50
    low, low_part, high, high_part = quality.cut_of(counts, 10, 20)
    assert (low, high) == (100, 100) and (low_part, high_part) == (0.2, 0.4)
