import random
import re
from collections import Counter

import pytest

from footfall.llm.substrings import block_size, drop_repeats


def brute(texts, n):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i:i + n]) for w in words for i in range(len(w) - n + 1))
    out = []
    for w in words:
        gone = {j for i in range(len(w) - n + 1) if seen[tuple(w[i:i + n])] > 1 for j in range(i, i + n)}
        out.append((len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


@pytest.mark.parametrize("window", [4, 5, 35])
def test_equals_brute_force(spark, window):
    random.seed(window)
    passage = [f"p{i}" for i in range(3 * window)]
    texts = []
    for _ in range(120):
        text = random.choices(["a", "b", "c", "é"], k=random.randint(0, 3 * window))
        if random.random() < 0.5:
            at = random.randrange(2 * window)
            cut = passage[at:at + window + random.randint(-2, 6)]
            text[random.randint(0, len(text)):0] = cut
        texts.append(random.choice([" ", "\n", "\t "]).join(text))
    texts += [None, "", " ", texts[3], texts[3], " ".join(passage), "z " * (5 * window),
              " ".join(f"u{i}" for i in range(20_000))]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in drop_repeats(
        docs.repartition(5), window=window).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, window)


def test_every_window_holds_a_whole_block():
    for n in range(1, 80):
        b = block_size(n)
        assert all(any(s <= k * b and (k + 1) * b <= s + n for k in range(300 // b + 1))
                   for s in range(b))


def test_hot_passage_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr("footfall.llm.exchange.CHUNK_BYTES", 500)
    shared = " ".join(f"s{i}" for i in range(36))
    texts = [f"{shared} own{i}" if i % 3 == 0 else f"only {i}" for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    got = {r.doc_id: r.kept_text for r in drop_repeats(docs).collect()}
    assert all(got[i] == (f"own{i}" if i % 3 == 0 else f"only {i}") for i in range(300))


def test_empty_table_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b", "x", 2)], "doc_id long, body string, text string, n_words int")
    out = drop_repeats(docs, text="body")
    assert out.columns == ["doc_id", "text", "n_words", "n_removed", "kept_text"]
    assert [tuple(r) for r in out.collect()] == [(1, "x", 2, 0, "a b")]
    assert drop_repeats(docs.limit(0), text="body").count() == 0
