import hashlib
import json
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from footfall.llm import bpe, queries

public = pytest.importorskip("public_tokenizers")
FILE = public.path("word_bpe_49k.json")
TEXTS = ["Don't stop! It's 3.14, naïve café x y", None, "", " \t\n", "🙂 <|endoftext|>a <|x", "ΣΑΣ ΟΔΟΣ",
         "é ́a", "word " * 3000, "x" * 5_000, "a\x1fb\x85c", "same", "same", "a b  c", "ABC'S ≮",
         "ab" * 300 + "<|startoftext|><|startoftext|>", "aaaaaaa aaa" * 9, "中文字符测试。日本語テキスト" * 40, "a\x00b"]


def merged(symbols, merges):
    """Apply each merge to the whole word, the first merge first."""
    word = list(symbols)
    for u, v, made in merges:
        at = 0
        while at < len(word) - 1:
            if word[at] == u and word[at + 1] == v:
                word[at:at + 2] = [made]
            at += 1
    return word


@st.composite
def vocabularies(draw):
    spelled = {(i,): i for i in range(3)}
    merges = []
    for _ in range(draw(st.integers(0, 14))):
        u, v = draw(st.sampled_from(sorted(spelled))), draw(st.sampled_from(sorted(spelled)))
        if u + v not in spelled and len(u + v) <= 9:
            merges.append((spelled[u], spelled[v], len(spelled)))
            spelled[u + v] = len(spelled)
    return len(spelled), merges


@settings(max_examples=400, deadline=None)
@given(vocabularies(), st.lists(st.lists(st.integers(0, 2), min_size=1, max_size=14), max_size=8),
       st.lists(st.integers(0, 2), min_size=65, max_size=90))
def test_automaton_spells_what_merging_gives(vocabulary, words, long_word):
    n_tokens, merges = vocabulary
    words = [*words, long_word]
    tokens, first = bpe.compile_merges(n_tokens, merges).encode(
        np.array([s for w in words for s in w]), np.cumsum([0, *map(len, words)]))
    found = [tokens[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]
    assert found == [merged(word, merges) for word in words]


def test_dead_merges_add_no_gadget():
    # 0 1 always becomes 3 first, so 1 2 -> 4 never meets 0 1 2; and 5 = 0 4 is never made
    merges = [(0, 1, 3), (1, 2, 4), (0, 4, 5)]
    tokens, _ = bpe.compile_merges(6, merges).encode(np.array([0, 1, 2, 1, 2]), np.array([0, 3, 5]))
    assert tokens.tolist() == [3, 2, 4]


@pytest.mark.parametrize("merges", [[(0, 1, 3), (1, 2, 4), (3, 2, 5), (0, 4, 5)], [(3, 2, 5), (0, 1, 3)]])
def test_vocabularies_that_do_not_fit_are_refused(merges):
    with pytest.raises(ValueError, match="token"):
        bpe.compile_merges(6, merges)


def test_settings_that_are_not_built_are_refused(tmp_path):
    whole = json.load(open(FILE, encoding="utf-8"))
    for change in ({"decoder": {"type": "Fuse"}}, {"model": {**whole["model"], "dropout": 0.1}}):
        path = tmp_path / "tokenizer.json"
        path.write_text(json.dumps({**whole, **change}))
        with pytest.raises(ValueError):
            bpe.compile_tokenizer(str(path))


def test_equals_the_library(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(FILE)
    random.seed(3)
    alphabet = "abcdeéÉ ñ's.,\n\t0<|>ĠT中🙂́"
    texts = TEXTS + ["".join(random.choices(alphabet, k=random.randint(0, 60))) for _ in range(300)]
    docs = spark.createDataFrame([(i, t, "k", "z") for i, t in enumerate(texts)],
                                 "doc_id long, text string, Ids string, `a.b` string").repartition(3)
    out = bpe.encode_documents(docs, FILE)
    assert out.columns == ["doc_id", "a.b", "n_tokens", "ids"]
    back = bpe.decode_documents(out, FILE)
    assert back.columns == [*out.columns, "decoded"]
    rows = {r.doc_id: r for r in back.collect()}
    for i, text in enumerate(texts):
        want = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(rows[i].ids), "<u4").tolist() == want and rows[i].n_tokens == len(want), text
        assert rows[i].decoded == tokenizer.decode(want, skip_special_tokens=False)
    assert bpe.decode_documents(bpe.encode_documents(docs.limit(0), FILE), FILE).count() == 0


def test_decoding_skips_unknown_ids_and_null(spark):
    ids = np.array([320, 49406, 60_000, 320], dtype="<u4").tobytes()
    out = bpe.decode_documents(spark.createDataFrame([(1, ids), (2, None)], "n int, ids binary"), FILE, keep=["n"])
    assert sorted(map(tuple, out.collect())) == [(1, "a</w> <|startoftext|> a</w>"), (2, "")]


def test_tasks_forget_when_their_memory_is_full(monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 3)
    compiled = bpe.compile_tokenizer(FILE)
    small = bpe.WordEncoder(compiled)
    for text in (b"one two three four five", b"six one two", b"", b"one two"):
        ids, first = small.encode([text, None])
        want, _ = bpe.WordEncoder(compiled).encode([text, None])
        assert ids.tolist() == want.tolist() and first[-1] == len(ids)


def test_query_over_the_whole_table(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(FILE)
    sf_dir = "/root/testdata/sf0.001"
    found = {r.doc_id: r for r in queries.QUERIES["op13_bpe"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(found) == len(docs)
    for doc in docs:
        ids = tokenizer.encode(doc.text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        row = found[doc.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
