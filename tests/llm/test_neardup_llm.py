import random
import re
from math import comb

import numpy as np
import pyarrow as pa

from footfall.llm import neardup
from footfall.llm.graph import components
from footfall.llm.neardup import COORDINATES, MATCHES, SIMILARITY, _joined, near_duplicates

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def closed(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def brute(rows):
    own = {i: sets_of(t) for i, t in rows}
    ids = sorted(own)
    links = [(a, b) for a in ids for b in ids if a < b and own[a]
             and 100 * len(own[a] & own[b]) >= 75 * len(own[a] | own[b])]
    return {i: (len(own[i]), c, c == i) for i, c in closed(ids, links).items()}


def corpus():
    random.seed(8)
    rows, base = [], ["".join(random.choices("abcdefgh", k=4)) for _ in range(4000)]
    for group in range(12):
        text = random.choices(base, k=random.randint(30, 200))
        for copy in range([2, 3, 5, 40][group % 4]):
            edited = list(text)
            for _ in range(random.choice([0, 1, 1, 2, 3]) if copy else 0):
                edited[random.randrange(len(edited))] = random.choice(base)
            rows.append(" ".join(edited))
    rows += [" ".join(random.choices(base, k=60)) for _ in range(60)]
    common = " ".join(random.choices(base, k=40))
    rows += [f"{common} {' '.join(random.choices(base, k=90))}" for _ in range(60)]
    rows += [None, "", " ", "one", "ONE", "one two", "One  two", rows[0], rows[0].upper(),
             " ".join(random.choices(base, k=30_000))]
    random.shuffle(rows)
    return list(enumerate(rows, start=10))


def test_equals_all_pairs(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs).collect()}
    assert got == brute(rows)


def test_chains_and_large_groups_of_near_copies(spark):
    random.seed(6)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(150):  # each differs from the next a little, from most of the others a lot
        words[random.randrange(400)] = f"n{i}"
        if i % 2:
            words[random.randrange(400)] = f"m{i}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_duplicates(docs).collect()}
    assert got == {i: c for i, (_, c, _) in brute(rows).items()}


def test_null_keys_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(5, "a b c d e f", 1), (5, "a b c d e f", 2), (None, "a b c d e f", 3),
                                  (7, "A b c d e f", 4), (8, None, 5)], "doc_id int, text string, _key int")
    out = near_duplicates(docs)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted((tuple(r) for r in out.collect()), key=repr) == sorted([
        (5, 2, 5, True), (5, 2, 5, True), (7, 2, 5, False), (8, 0, 8, True), (None, 2, None, True)], key=repr)
    assert near_duplicates(docs.limit(0)).count() == 0


def test_more_links_join_components(spark):
    first = [(1, 2), (3, 4), (5, 6), (9, 8)]
    more = [(2, 4), (7, 6), (20, 21), (8, 1)]
    found = _joined(None, spark.createDataFrame(first, "a long, b long"))
    found = _joined(found, spark.createDataFrame(more, "a long, b long"))
    rows = found.select("node", "component").collect()
    want = closed(range(30), first + more)
    assert len(rows) == 11 and {r.node: r.component for r in rows} == {r.node: want[r.node] for r in rows}


def test_components_of_a_path_a_star_and_a_cycle(spark):
    links = [(i, i + 1) for i in range(50, 90)] + [(200, i) for i in range(201, 260)]
    links += [(300, 301), (301, 302), (302, 300), (7, 7), (None, 4), (90, 3)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    want = closed(range(400), [link for link in links if None not in link])
    got = {r.node: r.component for r in found}
    assert len(found) == len(got) and got == {n: want[n] for n in got}
    assert set(got) == {3, *range(50, 91), *range(200, 260), 300, 301, 302}


def test_signatures_miss_hardly_a_pair_at_the_threshold():
    p = SIMILARITY / 100
    missed = sum(comb(COORDINATES, k) * p ** k * (1 - p) ** (COORDINATES - k) for k in range(MATCHES))
    assert missed < 2e-6


def test_many_documents_around_the_threshold(spark):
    """A group that looks alike, of which some pairs are just similar enough and most are not."""
    random.seed(12)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(260):
        words = list(base)
        for at in random.sample(range(120), random.choice([1, 2, 3, 4, 5])):
            words[at] = f"x{i}_{at}"
        rows.append((i, " ".join(words)))
    for i in range(260, 300, 2):  # alike, and of many sizes
        words = base[:random.randint(60, 120)] + [f"y{i}_{j}" for j in range(random.randint(5, 40))]
        rows += [(i, " ".join(words)), (i + 1, " ".join(words[2:] + [f"z{i}"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs).collect()}
    assert got == brute(rows)
    assert 20 < sum(kept for _, _, kept in got.values()) < 290


def test_common_shingles_and_forests_equal_plain_sets():
    rng = np.random.default_rng(3)
    blocks, sets = [], []
    for n, start in ((40, 0), (25, 40)):
        own = [np.unique(rng.choice(6000, rng.integers(1, 400))).astype(np.uint64) for _ in range(n)]
        own[3] = own[7] = own[0]
        begins = np.cumsum([0, *map(len, own)])
        blocks.append(pa.RecordBatch.from_arrays(
            [pa.array(range(start, start + n)), pa.array([start] * 2 + list(range(start + 2, start + n))),
             pa.LargeListArray.from_arrays(pa.array(begins), pa.array(np.concatenate(own)))], ["key", "component", "set"]))
        sets.append([set(s.tolist()) for s in own])
    for a, b in ((0, 1), (0, 0)):
        want = [[len(x & y) for y in sets[b]] for x in sets[a]]
        assert neardup.common_shingles(blocks[a], blocks[b]).tolist() == want
    found = sorted(zip(*map(list, neardup._forest(blocks[0], None, 75))))
    assert len(found) == 2 and {x for pair in found for x in pair} <= {0, 3, 7}  # 0, 3 and 7 are one set
