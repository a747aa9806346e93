import random
import re

from footfall.llm.decontaminate import contamination
from footfall.llm.exchange import hidden  # noqa: F401

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(text, items, n=10):
    own, hit, named = words(text), set(), set()
    for name, item in items:
        w = words(item)
        for i in range(max(1, len(w) - n + 1) if w else 0):
            window = w[i:i + n]
            for s in range(len(own) - len(window) + 1):
                if own[s:s + len(window)] == window:
                    hit.update(range(s, s + len(window)))
                    named.add("" if name is None else str(name))
    return len(own), len(hit), sorted(named)


def corpus():
    random.seed(3)
    vocabulary = ["ab", "Cd", "é", "x1", "7"]
    line = lambda k: " ".join(random.choices(vocabulary, k=k))
    items = [(i, line(random.randint(9, 16))) for i in range(25)]
    items += [(30, "é!"), (31, "x1, 7 ab"), (None, line(12)), (32, None), (33, ""), (34, "..."), (2, items[2][1])]
    docs = [line(random.randint(0, 60)) for _ in range(60)]
    docs += [f"{line(5)} {items[i][1].upper()} {line(3)}" for i in range(20)]
    docs += [None, "", "--", "ab " * 30_000 + items[1][1], items[0][1]]
    return docs, items


def test_equals_brute_force_in_one_pass_and_in_many(spark):
    texts, items = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for options in ({}, {"pass_bytes": 3000}):
        got = {r.doc_id: r for r in contamination(docs, bench, **options).collect()}
        assert len(got) == len(texts)
        for i, text in enumerate(texts):
            if text and len(text) > 10_000:
                assert got[i].n_hit >= len(words(items[1][1])) and "1" in got[i]["items"]
                continue
            row = got[i]
            assert (row.n_words, row.n_hit, row["items"]) == brute(text, items)
            assert sum(b - a for a, b in zip(row.hit_from, row.hit_to, strict=True)) == row.n_hit


def test_empty_tables_repeated_rows_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b c", "t", 7)] * 2, "doc_id long, text string, _text string, n_hit int")
    bench = spark.createDataFrame([(1, "B C")], "item_id long, text string")
    out = contamination(docs, bench)
    assert out.columns == ["doc_id", "text", "_text", "n_words", "n_hit", "items", "hit_from", "hit_to"]
    assert [tuple(r) for r in out.collect()] == [(1, "a b c", "t", 3, 2, ["1"], [1], [3])] * 2
    assert [r.n_hit for r in contamination(docs, bench.limit(0)).collect()] == [0, 0]
    assert contamination(docs.limit(0), bench).count() == 0
