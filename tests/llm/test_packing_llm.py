import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from footfall.llm.packing import Packer, fill, pack_documents, powers_of_two

public = pytest.importorskip("public_tokenizers")
FILE = public.path("word_bpe_49k.json")


def best_sum(counts, capacity):
    longest = max(counts)
    sums = {longest}
    for length, n in counts.items():
        for _ in range(n - (length == longest)):
            sums |= {s + length for s in sums if s + length <= capacity}
    return max(sums)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 5), min_size=1, max_size=8))
def test_fill_is_the_closest_multiset(counts):
    taken = fill(np.array([counts.get(i, 0) for i in range(64)]), 64)
    assert all(0 < n <= counts[length] for length, n in taken.items()) and max(counts) in taken
    assert sum(length * n for length, n in taken.items()) == best_sum(counts, 64)


def test_packer_places_every_id_once_without_padding():
    random.seed(2)
    packer, docs = Packer(64, 100), [np.arange(random.randint(1, 200), dtype="<u4") for _ in range(300)]
    for i, ids in enumerate(docs):
        packer.add((i, len(ids)), ids)
        if packer.n_waiting >= 40:
            packer.pack(leave=20)
    packer.pack()
    found, filled = defaultdict(list), defaultdict(list)
    for (i, _), start, length, number, offset, data in packer.rows:
        found[i].append((start, data))
        filled[number].append((offset, length))
        assert len(data) == 4 * length
    for i, ids in enumerate(docs):
        assert b"".join(d for _, d in sorted(found[i])) == ids.tobytes()
    for pieces in filled.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64 and at & (at - 1) == 0
    assert powers_of_two(13) == [8, 4, 1]


def test_round_trip_through_the_tokenizer(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(FILE)
    texts = ["Don't stop! It's 3.14, naïve café x y", None, "", " \t\n", "🙂 <|endoftext|>a <|x", "ΣΑΣ ΟΔΟΣ",
             "é ́a", "word " * 5000, "x" * 30_000, "a\x1fb\x85c", "same", "same"]
    docs = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)],
                                 "doc_id long, text string, start string").repartition(3)
    out = pack_documents(docs, FILE)
    assert out.columns == ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    pieces, sequences = defaultdict(list), defaultdict(int)
    for r in out.collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id] += r.length
    for i, text in enumerate(texts):
        want = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        rows = sorted(pieces[i], key=lambda r: r.start)
        assert b"".join(bytes(r.ids) for r in rows) == np.array(want, dtype="<u4").tobytes()
        assert {r.doc_tokens for r in rows} == {len(want)}
    assert all(n == 2048 or n & (n - 1) == 0 for n in sequences.values())
    assert pack_documents(docs.limit(0), FILE).count() == 0
