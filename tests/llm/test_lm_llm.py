import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from footfall.llm.lm import (
    CLASSES, FIT, HELD, HELD_PART, ROUNDS, score_documents,
)
from footfall.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def corpus():
    random.seed(12)
    words = [f"w{i}" for i in range(30)] + ["É", "The"]
    texts = []
    for _ in range(250):
        word, text = random.choice(words), []
        for _ in range(random.randint(0, 25)):
            text.append(word)
            word = words[(words.index(word) * 7 + random.choice([1, 1, 1, 2, 5])) % len(words)]
        texts.append(" ".join(text))
    return [*texts, None, "", "never seen", " ".join(random.choices(words, k=5000)), texts[0]]


def role(i):
    hashed = zlib.crc32(str(i).encode())
    return None if hashed % 5 == 1 else HELD if hashed // 5 % HELD_PART == 0 else FIT


def brute(rows, order):
    """Plain recursion over dictionaries, with the same classes and rounds."""
    seqs = {i: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) + ["</s>"] for i, t in rows}

    def grams(seq, k):
        padded = ["<s>"] * (k - 1) + seq
        return [tuple(padded[j:j + k]) for j in range(len(seq))]

    def counts(roles):
        chosen = [s for i, s in seqs.items() if role(i) in roles]
        found = {k: Counter(g for s in chosen for g in grams(s, k)) for k in range(1, order + 1)}
        context = {k: Counter(g[:-1] for s in chosen for g in grams(s, k)) for k in range(1, order + 1)}
        return found, context, sum(found[1].values())

    def parts(seq, found, context, total, distinct):
        out, own = [], {k: grams(seq, k) for k in range(1, order + 1)}
        for j in range(len(seq)):
            row = [(1 / (distinct + 1), 0)]
            for k in range(1, order + 1):
                g = own[k][j]
                seen = total if k == 1 else context[k][g[:-1]]
                row.append((found[k][g] / seen if seen else 0,
                            min(int(math.log2(seen)) + 1, CLASSES - 1) if seen else 0))
            out.append(row)
        return out

    fit, every = counts({FIT}), counts({FIT, HELD})
    distinct = len(every[0][1])
    weights = np.full((order + 1, CLASSES), 0.5)
    weights[:, 0] = 0
    held = [r for i, s in seqs.items() if role(i) == HELD for r in parts(s, *fit, distinct)]
    for _ in range(ROUNDS):
        made, reached = np.zeros_like(weights), np.zeros_like(weights)
        for row in held:
            share, left = [0.0] * (order + 1), 1.0
            for k in range(order, 0, -1):
                w = weights[k][row[k][1]]
                share[k], left = left * w * row[k][0], left * (1 - w)
            share[0] = left * row[0][0]
            total = sum(share)
            for k in range(1, order + 1):
                made[k][row[k][1]] += share[k] / total
                reached[k][row[k][1]] += sum(share[:k + 1]) / total
        weights = np.where(reached > 0, made / np.maximum(reached, 1e-300), weights)
        weights[:, 0] = 0
    out = {}
    for i, seq in seqs.items():
        score = base = 0.0
        for token, row in zip(seq, parts(seq, *every, distinct), strict=True):
            p = row[0][0]
            for k in range(1, order + 1):
                w = weights[k][row[k][1]]
                p = w * row[k][0] + (1 - w) * p
            score += math.log10(p)
            base += math.log10((every[0][1][token,] + 0.5) / (every[2] + 0.5 * (distinct + 1)))
        out[i] = (zlib.crc32(str(i).encode()) % 5 == 1, len(seq), sum(every[0][1][t,] > 0 for t in seq),
                  every[2], base, score)
    return out


@pytest.mark.parametrize("order", [2, 3])
def test_equals_brute_force(spark, order, monkeypatch):
    monkeypatch.setattr("footfall.llm.exchange.CHUNK_BYTES", 2000)
    rows = list(enumerate(corpus()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in score_documents(docs, order=order).collect()}
    want = brute(rows, order)
    assert set(got) == set(want)
    for i, row in want.items():
        assert got[i][:4] == row[:4]
        assert got[i][4:] == pytest.approx(row[4:], rel=1e-9)
    held = [i for i in want if want[i][0]]
    assert sum(want[i][5] for i in held) > sum(want[i][4] for i in held)


def test_null_keys_repeated_rows_clashing_names_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b", 1), (1, "a b", 2), (None, "zz", 3), (2, None, 4)],
                                 "doc_id int, text string, _key int")
    out = score_documents(docs)
    assert out.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    assert got[0] == got[1] and [r for r in got if r[0] is None][0][1:4] == (False, 2, 1)
    assert score_documents(docs.limit(0)).count() == 0


def test_the_registered_query_has_the_highest_order(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r.doc_id: r.score for r in score_documents(docs, order=3).collect()}
    got = {r.doc_id: r.score for r in QUERIES["op4_lm_score"](spark, "/root/testdata/sf0.001").collect()}
    assert got == pytest.approx(want, abs=1e-9)
