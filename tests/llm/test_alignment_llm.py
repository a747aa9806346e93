import hashlib
import random
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from itertools import accumulate

import numpy as np
import pytest

from footfall.llm import alignment, queries

public = pytest.importorskip("public_tokenizers")
FILE_A, FILE_B = public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")
TEXTS = [
    "Don't stop! It's 3.14, naïve café x y", None, "", " ", "  ", " \t\n", "a", "a ", "a  ", " a", "  a b   c",
    "🙂 <|endoftext|>a <s> </s><unk> <0x0A>", "ΣΑΣ ΟΔΟΣ", "é ́a", "word " * 3000, "x" * 5000, "a\x1fb\x85c d",
    "a　 b  c  d", "▁", "a▁b c", "same text here", "same text here", "中文字符 测试。日本語 テキスト" * 40,
    "नमस्ते दुनिया", "a\x00b\nc\r\n d", "Ａ ｂ", "🙂🙂 🙂é🙂", "﻿ x", "aé à́ ñ",
]


def brute(texts):
    """Everything from decoded bytes, whole text by whole text, pair by pair."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(FILE_A), SentencePieceProcessor(model_file=FILE_B)
    a.encode_special_tokens = True
    letters = alignment.byte_letters()

    def bytes_b(piece):
        found = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        return bytes([int(found[1], 16)]) if found else piece.replace("▁", " ").encode()

    found = []
    for text in texts:
        groups = []
        if text:
            ids_a = a.encode(" " + text, add_special_tokens=False).ids
            ids_b = b.encode(text)
            of_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
            of_b = [bytes_b(b.id_to_piece(i)) for i in ids_b]
            if b"".join(of_a) == b"".join(of_b) == (" " + text).encode():
                ends_a = list(accumulate(map(len, of_a)))
                ends_b = list(accumulate(map(len, of_b)))
                cuts = sorted(set(ends_a) & set(ends_b))
                groups = [([], []) for _ in cuts]
                for side, (ids, ends) in enumerate(((ids_a, ends_a), (ids_b, ends_b))):
                    for i, e in zip(ids, ends):
                        groups[bisect_left(cuts, e)][side].append(i)
        found.append(groups)
    links = [Counter((x, y) for one, two in groups for x in one for y in two) for groups in found]
    counts = Counter(pair for own in links for pair in own)
    highest = defaultdict(int)
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    rows = []
    for groups, own in zip(found, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append((
            sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(own.values()),
            sum(n for p, n in own.items() if counts[p] == highest[p[0]]),
            sum(n * counts[p] for p, n in own.items()),
            hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return rows


# the brute force scans all ends per group, so its long texts are kept short
SHORT = [t if t is None or len(t) < 600 else t[:600] for t in TEXTS]
NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_equals_brute_force(spark):
    random.seed(5)
    alphabet = "aabcdeéÉ  ñ's.,\n0<|>中🙂́　"
    texts = SHORT + ["".join(random.choices(alphabet, k=random.randint(0, 60))) for _ in range(200)]
    docs = spark.createDataFrame([(i, t, "k", "z", 1) for i, t in enumerate(texts)],
                                 "doc_id long, text string, `a.b` string, N_A string, chunk int").repartition(3)
    out = alignment.align_documents(docs, FILE_A, FILE_B)
    assert out.columns == ["doc_id", "a.b", "chunk", *NAMES]
    rows = {r.doc_id: r for r in out.collect()}
    for i, want in enumerate(brute(texts)):
        assert tuple(rows[i][n] for n in NAMES) == want, texts[i]
    assert alignment.align_documents(docs.limit(0), FILE_A, FILE_B).count() == 0


def test_long_texts_are_spelled_whole():
    known = alignment.Segments(alignment.TokenizerPair(FILE_A, FILE_B))
    for text in ("word " * 50_000, "x" * 50_000, "日本語" * 20_000):
        found = alignment.align([text.encode()], known)
        whole = alignment.Segments(known.pair)
        raw = b" " + text.encode()
        whole.learn(np.array([1], dtype=np.uint64), [raw], 1)
        assert whole.right.all() and found.counts[0].tolist() == whole.counts[0].tolist()
        assert found.digests[0] == hashlib.sha256(whole.text.tobytes()[:-1]).hexdigest()


def test_refined_cuts_characters_and_fallback_bytes_by_decoded_bytes():
    labels = alignment.Labels([b" ", b"\xef", b"\xbc", b"\xa1", b"ab", b" x"])
    # one segment " Ａab", whose character is three bytes with spans (1, 1), (1, 1), (1, 4)
    found = alignment.refined(
        np.array([0, 1, 2, 3, 4]), np.array([0, 1, 1, 1, 4]), np.array([1, 1, 1, 4, 6]),
        np.zeros(5, dtype=np.int64), np.array([0, 6]), labels)
    assert found.ends.tolist() == [1, 2, 3, 4, 6]
    raw = np.frombuffer(" Ａab x".encode(), dtype=np.uint8)
    both = alignment.Tokens(np.array([0, 1, 2, 3, 4, 5]), np.array([1, 2, 3, 4, 6, 8]), np.array([0, 0, 0, 0, 0, 1]))
    assert alignment.exact(both, raw, np.array([0, 6, 8]), labels).tolist() == [True, True]
    both.ids[1] = 2
    assert alignment.exact(both, raw, np.array([0, 6, 8]), labels).tolist() == [False, True]


def test_many_equal_tokens_of_a_group_are_counted_not_multiplied():
    n = 30_000
    pairs, times, group = alignment._products(
        np.zeros(n, dtype=np.int64), np.full(n, 7), np.zeros(n, dtype=np.int64), np.arange(n) % 2, 1)
    assert sorted(zip((pairs % alignment.PAIR).tolist(), times.tolist())) == [(0, n * n // 2), (1, n * n // 2)]


def test_tasks_forget_when_their_memory_is_full(monkeypatch):
    monkeypatch.setattr(alignment, "KNOWN_SEGMENTS", 2)
    pair = alignment.TokenizerPair(FILE_A, FILE_B)
    small = alignment.Segments(pair)
    for text in (b"one two three four", b"six one two", b"one two"):
        found, want = alignment.align([text, None], small), alignment.align([text, None], alignment.Segments(pair))
        assert found.digests == want.digests and found.pairs.tolist() == want.pairs.tolist()


def test_query_over_the_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    found = {r.doc_id: r for r in queries.QUERIES["op12_alignment"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(found) == len(docs)
    for doc, want in zip(docs, brute([d.text for d in docs]), strict=True):
        assert tuple(found[doc.doc_id][n] for n in NAMES) == want, doc.doc_id
