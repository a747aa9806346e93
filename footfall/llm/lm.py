"""LM scoring: n-gram estimates mixed by context frequency, weights learned on held-out counts."""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from footfall.llm.exchange import (
    CHUNK_BYTES, CHUNK_SCHEMA, answered_rows, bucket_count, bucket_cuts, bucket_rows, chunk_rows, counts_of,
    numbers, packed, release, slices, small_counts, texts_of, write_blobs,
)
from footfall.llm.words import window_hashes, words_of

ORDER = 3
START, END = np.uint64(0x9AE16A3B2F90404F), np.uint64(0xC949C7DEFB7A1B51)
#: Context frequencies fall into powers of two, and the last class holds all larger ones.
CLASSES = 24
ROUNDS = 12
#: One in so many training documents gives the held-out counts.
HELD_PART = 10
KEY_BYTES = 6
#: Bytes of text for which a bucket is worth while: smaller ones make more and tinier pieces of a chunk.
BUCKET_TEXT = 1 << 19
EM_TOKENS = 1 << 12
FIT, HELD, OTHER = 0, 1, 2


@dataclass
class Totals:
    """Of training tokens: all and distinct; of the part without held-out documents, all;
    documents of both."""

    tokens: int
    distinct: int
    fit_tokens: int
    docs: int
    fit_docs: int


def ngrams(texts: list[bytes | None], order: int, levels: Iterable[int] | None = None
           ) -> tuple[list[np.ndarray], np.ndarray]:
    """For each order from 1 (or for each of ``levels``), the hash of the n-gram that ends with each
    token; and where each text's tokens begin.  A text's tokens are its words and one end; starts
    come before it."""
    words = words_of(texts, lower=True)
    n_texts, pad = len(texts), order - 1
    first = words.first[:-1] + np.arange(n_texts)
    text = words.text_of()
    place = np.arange(len(words.start)) + (text + 1) * pad + text
    padded = np.full(len(words.start) + n_texts * (pad + 1), START, dtype=np.uint64)
    padded[place] = words.hashes
    ends = words.first[1:] + (np.arange(n_texts) + 1) * pad + np.arange(n_texts)
    padded[ends] = END
    token = np.sort(np.concatenate((place, ends)))
    begins = np.concatenate((first, [len(token)]))
    return [window_hashes(padded, k)[token - k + 1] for k in levels or range(1, order + 1)], begins


def _role(column: Column) -> Column:
    """FIT, HELD or OTHER: documents to learn counts from, to learn weights from, and others."""
    hashed = F.crc32(column.cast("string").cast("binary"))
    return F.when(hashed % 5 == 1, OTHER).when(F.floor(hashed / 5) % HELD_PART == 0, HELD) \
        .otherwise(F.when(column.isNull(), OTHER).otherwise(FIT))


def _pack_keys(keys: np.ndarray) -> bytes:
    """The low bytes of each key; the bucket stands for the high ones."""
    return np.ascontiguousarray(
        keys.astype("<u8").view("u1").reshape(-1, 8)[:, :KEY_BYTES]).tobytes()


def _unpack_keys(value: pa.Scalar) -> np.ndarray:
    raw = numbers(value, "u1").reshape(-1, KEY_BYTES)
    full = np.zeros((len(raw), 8), dtype="u1")
    full[:, :KEY_BYTES] = raw
    return full.view("<u8").ravel()


ASKED = "bucket long, chunk long, keys binary, fit binary, held binary"


def _ask(chunk: int, batch: pa.RecordBatch, levels: list[int], order: int, n_buckets: int) -> Iterator[dict]:
    """Per bucket: distinct n-grams of some orders, each with buckets of its own, and how often training
    texts have them."""
    grams, begins = ngrams(texts_of(batch), order, levels)
    role = np.repeat(batch["_role"].to_numpy(zero_copy_only=False), np.diff(begins))
    for level, own in zip(levels, grams, strict=True):
        found, which = np.unique(own, return_inverse=True)
        fit = np.bincount(which[role == FIT], minlength=len(found))
        held = np.bincount(which[role == HELD], minlength=len(found))
        cuts = bucket_cuts(found, n_buckets)
        rows: dict[str, list] = {n: [] for n in ("bucket", "chunk", "keys", "fit", "held")}
        for bucket in np.flatnonzero(np.diff(cuts)).tolist():
            piece = slice(cuts[bucket], cuts[bucket + 1])
            rows["bucket"].append(level * n_buckets + bucket)
            rows["chunk"].append(chunk)
            rows["keys"].append(_pack_keys(found[piece]))
            rows["fit"].append(_pack_few(fit[piece]))
            rows["held"].append(_pack_few(held[piece]))
        yield rows


def _pack_few(counts: np.ndarray) -> bytes:
    """A bit for each count that is not 0, then one for each of these that is not 1, then those."""
    some = counts[counts > 0]
    more = some[some > 1]
    return (np.packbits(counts > 0).tobytes() + np.packbits(some > 1).tobytes()
            + more.astype("<u4").tobytes())


def _unpack_few(value: pa.Scalar, n: int) -> np.ndarray:
    raw = numbers(value, "u1")
    out = np.unpackbits(raw, count=n).astype(np.int64)
    at, raw = np.flatnonzero(out), raw[-(-n // 8):]
    more = np.unpackbits(raw, count=len(at)).astype(bool)
    out[at[more]] = np.frombuffer(raw[-(-len(at) // 8):].tobytes(), dtype="<u4")
    return out


ANSWER = "chunk long, bucket long, fit binary, total binary, tokens long, distinct long, fit_tokens long"


def _answer(table: pa.Table) -> dict:
    """For each chunk the corpus counts of its n-grams, and once per bucket its share of totals.

    Only held-out chunks (the odd ones) need the counts without held-out documents.
    """
    keys = [_unpack_keys(v) for v in table["keys"]]
    sizes = [len(k) for k in keys]
    found, which = np.unique(np.concatenate(keys), return_inverse=True)

    def total_of(column: str) -> np.ndarray:
        parts = [_unpack_few(v, n) for v, n in zip(table[column], sizes, strict=True)]
        return np.bincount(which, np.concatenate(parts), len(found)).astype(np.int64)

    fit = total_of("fit")
    total = fit + total_of("held")
    ends = np.cumsum(sizes)
    pieces = [which[e - n:e] for e, n in zip(ends, sizes, strict=True)]
    chunks = table["chunk"].to_pylist()
    rest = [None] * len(pieces)
    return {
        "chunk": [*chunks, -1],
        "bucket": [*table["bucket"].to_pylist(), table["bucket"][0].as_py()],
        "fit": [*(small_counts(fit[p]) if c % 2 else None
                  for p, c in zip(pieces, chunks, strict=True)), None],
        "total": [*(small_counts(total[p]) for p in pieces), None],
        "tokens": [*rest, int(total.sum())],
        "distinct": [*rest, int((total > 0).sum())],
        "fit_tokens": [*rest, int(fit.sum())],
    }


def _counts(grams: list[np.ndarray], answers: pa.Table, column: str, n_buckets: int,
            begins: np.ndarray, n_docs: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each order, the corpus count of each token's n-gram and of its context.

    The context of order 1 is empty; its count is left 0 and the caller knows the total.
    """
    levels, buckets = np.divmod(answers["bucket"].to_numpy(), n_buckets)
    count = []
    for level, own in enumerate(grams, 1):
        found, which = np.unique(own, return_inverse=True)
        known = np.zeros(len(found), dtype=np.int64)
        cuts = bucket_cuts(found, n_buckets)
        for at in np.flatnonzero(levels == level).tolist():
            bucket = buckets[at]
            piece = slice(cuts[bucket], cuts[bucket + 1])
            known[piece] = counts_of(answers[column][at], piece.stop - piece.start)
        count.append(known[which])
    context = [np.zeros(len(count[0]), dtype=np.int64)]
    for k in range(1, len(grams)):
        before = np.concatenate(([0], count[k - 1][:-1]))
        # the context of a text's first token is starts only, as often as there are texts
        before[begins[:-1]] = n_docs
        context.append(before)
    return count, context


def _estimates(count: list[np.ndarray], context: list[np.ndarray], tokens: int,
               distinct: int) -> tuple[np.ndarray, np.ndarray]:
    """p[k]: the maximum-likelihood estimate of order k (0: uniform), and its context's class."""
    n = len(count[0])
    p, kind = np.zeros((len(count) + 1, n)), np.zeros((len(count) + 1, n), dtype=np.uint8)
    p[0] = 1 / (distinct + 1)
    for k, (c, before) in enumerate(zip(count, context, strict=True), start=1):
        seen = np.full(n, tokens) if k == 1 else before
        p[k] = np.where(seen > 0, c / np.maximum(seen, 1), 0)
        kind[k] = np.where(seen > 0, np.minimum(
            np.floor(np.log2(np.maximum(seen, 1))) + 1, CLASSES - 1), 0)
    return p, kind


def mixed(p: np.ndarray, kind: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """P_k = w p_k + (1 - w) P_(k-1) with the weight w of order k and the context's class."""
    total = p[0]
    for k in range(1, len(p)):
        w = weights[k][kind[k]]
        total = w * p[k] + (1 - w) * total
    return total


def expected(p: np.ndarray, kind: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Per order and class: how many tokens the order is expected to have made, and how many
    came as far down as to it."""
    part, rest = np.zeros_like(p), np.ones(p.shape[1])
    for k in range(len(p) - 1, 0, -1):
        w = weights[k][kind[k]]
        part[k], rest = rest * w * p[k], rest * (1 - w)
    part[0] = rest * p[0]
    share = part / np.maximum(part.sum(axis=0), 1e-300)
    reached = np.cumsum(share, axis=0)
    return np.array([[np.bincount(kind[k], share[k], CLASSES), np.bincount(kind[k], reached[k], CLASSES)]
                     for k in range(1, len(p))])


def learn_weights(held: DataFrame, order: int, rounds: int = ROUNDS) -> np.ndarray:
    """Expectation-maximisation over all held-out tokens, which stay where they are: a round
    gathers two numbers for each order and class.  Contexts never seen have weight 0."""
    weights = np.full((order + 1, CLASSES), 0.5)
    weights[:, 0] = 0
    for _ in range(rounds):
        now = weights.copy()

        def gather(batches: Iterable[pa.RecordBatch], now: np.ndarray = now
                   ) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((order, 2, CLASSES))
            for batch in batches:
                for p, kind in zip(batch["p"], batch["kind"], strict=True):
                    sums += expected(numbers(p, "<f8").reshape(order + 1, -1),
                                     numbers(kind, "u1").reshape(order + 1, -1), now)
            yield pa.RecordBatch.from_pydict({"place": np.arange(sums.size), "x": sums.ravel()})

        rows = (held.select("p", "kind").mapInArrow(gather, "place long, x double")
                .groupBy("place").agg(F.sum("x").alias("x")).collect())
        sums = np.zeros((order, 2, CLASSES))
        for row in rows:
            sums.ravel()[row.place] = row.x
        for k in range(1, order + 1):
            made, reached = sums[k - 1]
            weights[k] = np.where(reached > 0, made / np.maximum(reached, 1e-300), weights[k])
        weights[:, 0] = 0
    return weights


def _role_chunks(rows: DataFrame) -> DataFrame:
    """Write rows as numbered chunks, held-out ones (odd numbers) apart from others."""

    def row(parts: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        part = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        return pa.RecordBatch.from_pydict({
            "chunk": [number], "n_rows": [part.num_rows],
            "n_bytes": [sum(len(t or b"") for t in texts_of(part))],
            "data": pa.array([packed(part)], pa.binary())})

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 40
        waiting, size = [], 0
        for batch in batches:
            for part in slices(batch):
                is_held = pc.equal(part["_role"], HELD)
                held, rest = part.filter(is_held), part.filter(pc.invert(is_held))
                if rest.num_rows:
                    yield row([rest], 2 * number)
                    number += 1
                if held.num_rows:
                    waiting.append(held)
                    size += held.nbytes
                if size >= CHUNK_BYTES:
                    yield row(waiting, 2 * number + 1)
                    number, waiting, size = number + 1, [], 0
        if waiting:
            yield row(waiting, 2 * number + 1)

    return write_blobs(rows.mapInArrow(pack, CHUNK_SCHEMA), "chunks", compression="uncompressed")


RESULT = StructType([
    StructField("n_tokens", LongType()), StructField("n_known", LongType()),
    StructField("train_tokens", LongType()), StructField("base_score", DoubleType()),
    StructField("score", DoubleType()),
])


def score_documents(docs: DataFrame, text: str = "text", key: str = "doc_id",
                    order: int = ORDER) -> DataFrame:
    """Score every whole text by a deleted-interpolation model; one row per row of ``docs``.

    Tokens are the words of the text (runs of anything but blanks, A-Z lower-cased) and one end.
    The model learns from the rows whose crc32 of the key's text leaves another rest than 1 when
    divided by 5; a NULL key is not learned from.  ``held_out`` tells the rest is 1.  ``n_known``
    counts tokens met in training, ``train_tokens`` all training tokens; ``base_score`` is the
    log10 probability under unigrams with 0.5 added, ``score`` that under the model.

    Maximum-likelihood estimates up to ``order`` are interpolated down to the uniform one, each
    with a weight for the class of its context's frequency (powers of two).  The weights are
    learned by expectation-maximisation: one in ``HELD_PART`` training documents is held out,
    estimates come from the others, and the held-out tokens say how much each order deserves.
    The final estimates use all training documents.

    Counts cover the whole corpus.  They travel as distinct n-grams per chunk and bucket, those of the
    highest order after the others, so a very frequent word or pair is one entry per chunk; every chunk gets back
    the counts of its own n-grams only.  A NULL or empty text is its end alone.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("text"),
                       _role(F.col(key)).alias("_role"))
    chunks = _role_chunks(rows)
    held = chunks.where("pmod(chunk, 2) = 1")
    size = chunks.agg(F.sum("n_bytes").alias("n_bytes")).first().n_bytes or 0
    n_buckets = bucket_count(spark, size, BUCKET_TEXT)
    n_docs = {r._role: r.n for r in rows.groupBy("_role").agg(F.count(F.lit(1)).alias("n")).collect()}

    # the longest n-grams, which are most, by themselves: pieces of both are not on the disks at once
    found = []
    for levels in filter(None, ([*range(1, order)], [order])):
        asked = chunk_rows(chunks, lambda chunk, batch, own=levels: _ask(chunk, batch, own, order, n_buckets), ASKED)
        found.append(write_blobs(bucket_rows(asked, _answer, ANSWER), "counts"))
        release(spark)
    answers = reduce(DataFrame.unionByName, found)
    sums = found[0].where(f"chunk = -1 AND bucket < {2 * n_buckets}").agg(*(F.sum(c).alias(c) for c in (
        "tokens", "distinct", "fit_tokens"))).first()
    totals = Totals(sums.tokens or 0, sums.distinct or 0, sums.fit_tokens or 0,
                    n_docs.get(FIT, 0) + n_docs.get(HELD, 0), n_docs.get(FIT, 0))

    def features(chunk: int, batch: pa.RecordBatch, own: pa.Table) -> dict:
        grams, begins = ngrams(texts_of(batch), order)
        count, context = _counts(grams, own, "fit", n_buckets, begins, totals.fit_docs)
        p, kind = _estimates(count, context, totals.fit_tokens, totals.distinct)
        # rows of bounded size, whatever the chunk's
        cuts = range(0, p.shape[1], EM_TOKENS)
        return {"p": [p[:, i:i + EM_TOKENS].astype("<f8").tobytes() for i in cuts],
                "kind": [kind[:, i:i + EM_TOKENS].tobytes() for i in cuts]}

    weights = learn_weights(write_blobs(answered_rows(
        held, answers.where("pmod(chunk, 2) = 1 AND chunk >= 0").select("chunk", "bucket", "fit"),
        features, "p binary, kind binary"), "estimates"), order)

    def finish(chunk: int, batch: pa.RecordBatch, own: pa.Table) -> dict:
        grams, begins = ngrams(texts_of(batch), order)
        count, context = _counts(grams, own, "total", n_buckets, begins, totals.docs)
        p, kind = _estimates(count, context, totals.tokens, totals.distinct)
        base = np.log10((count[0] + 0.5) / (totals.tokens + 0.5 * (totals.distinct + 1)))
        score = np.log10(mixed(p, kind, weights))
        return {
            "_key": batch["_key"], "n_tokens": np.diff(begins),
            "n_known": np.add.reduceat(count[0] > 0, begins[:-1], dtype=np.int64),
            "train_tokens": [totals.tokens] * batch.num_rows,
            "base_score": np.add.reduceat(base, begins[:-1]),
            "score": np.add.reduceat(score, begins[:-1]),
        }

    scored = answered_rows(
        chunks, answers.where("chunk >= 0").select("chunk", "bucket", "total"), finish,
        StructType([StructField("_key", docs.schema[key].dataType), *RESULT.fields]))
    return scored.select(
        F.col("_key").alias(key),
        F.coalesce(F.crc32(F.col("_key").cast("string").cast("binary")) % 5 == 1, F.lit(False))
        .alias("held_out"), *RESULT.names)
