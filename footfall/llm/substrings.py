"""Substring dedup: fixed-block anchors, extended to maximal exact repeats of words."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from footfall.llm.exchange import (
    answered_rows, bucket_count, bucket_cuts, bucket_of, bucket_rows, chunk_rows, hidden,
    numbers, others, release, shown, texts_of, write_chunks,
)
from footfall.llm.words import Words, distinct, window_hashes, words_of
from footfall.scratch import write_aside

WINDOW = 35
LOW = np.uint64(0xFFFFFFFF)
ANSWER = "chunk long, bucket long, step int, data binary"


def block_size(window: int) -> int:
    """The largest block of which every window holds a whole one, wherever it starts."""
    return (window + 1) // 2


def _positions(words: Words) -> np.ndarray:
    """Each word's place in its text."""
    return np.arange(len(words.start)) - np.repeat(words.first[:-1], words.counts)


def _blocks(words: Words, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all rolling windows of ``block`` words within a text, and which of them are the
    text's non-overlapping reference blocks (as indexes of words)."""
    rolling = window_hashes(words.hashes, block)
    inside = words.left()[:len(rolling)] >= block
    fixed = np.flatnonzero(inside & (_positions(words)[:len(rolling)] % block == 0))
    return rolling[inside], np.column_stack((fixed.astype(np.uint64), rolling[fixed]))


def _pieces(ascending: np.ndarray, n_buckets: int) -> Iterator[tuple[int, slice]]:
    cuts = bucket_cuts(ascending, n_buckets)
    for bucket in np.flatnonzero(np.diff(cuts)).tolist():
        yield bucket, slice(int(cuts[bucket]), int(cuts[bucket + 1]))


def _ask_blocks(chunk: int, batch: pa.RecordBatch, block: int, n_buckets: int) -> dict:
    """Per bucket: the distinct rolling windows, those met twice, and the reference blocks."""
    words = words_of(texts_of(batch))
    rolling, fixed = _blocks(words, block)
    found, count = np.unique(rolling, return_counts=True)
    index = np.zeros(len(found), dtype=bool)
    index[np.searchsorted(found, fixed[:, 1])] = True
    rows: dict[str, list] = {"bucket": [], "chunk": [], "probes": [], "twice": [], "index": []}
    for bucket, piece in _pieces(found, n_buckets):
        low = (found[piece] & LOW).astype("<u4")
        rows["bucket"].append(bucket)
        rows["chunk"].append(chunk)
        rows["probes"].append(low.tobytes())
        rows["twice"].append(low[count[piece] > 1].tobytes())
        rows["index"].append(low[index[piece]].tobytes())
    return rows


def _within(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    """Which values are among the ascending ones."""
    if not len(ascending):
        return np.zeros(len(values), dtype=bool)
    return ascending[np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)] == values


def _answer_blocks(table: pa.Table) -> dict:
    """For each chunk, which of its reference blocks occur at another place of any text."""
    found = np.sort(np.concatenate([numbers(v, "<u4") for v in table["probes"]]))
    twice = np.concatenate([numbers(v, "<u4") for v in table["twice"]])
    again = distinct(np.concatenate((found[1:][found[1:] == found[:-1]], twice)))
    index = [numbers(v, "<u4") for v in table["index"]]
    flat = np.concatenate(index)
    hit = _within(flat, again)
    rows: dict[str, list] = {"chunk": [], "bucket": [], "step": [], "data": []}
    at = 0
    for chunk, bucket, own in zip(table["chunk"].to_pylist(), table["bucket"].to_pylist(), index,
                                  strict=True):
        own, at = own[hit[at:at + len(own)]], at + len(own)
        if len(own):
            rows["chunk"].append(chunk)
            rows["bucket"].append(bucket)
            rows["step"].append(0)
            rows["data"].append(own.tobytes())
    return rows


def _candidates(words: Words, answers: pa.Table, window: int, block: int,
                n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows whose own reference block is an anchor: index of the first word, and hash.

    A window holds exactly one whole reference block of its text (if the window has 2 * block - 1
    words; else at least one, of which the first is taken).  If the window occurs elsewhere, so
    does the block.
    """
    anchors = [np.empty(0, dtype=np.uint64)]
    for bucket, step, data in zip(answers["bucket"], answers["step"], answers["data"], strict=True):
        if step.as_py() == 0:
            anchors.append(numbers(data, "<u4").astype(np.uint64)
                           | np.uint64(bucket.as_py() << 32))
    anchor = np.sort(np.concatenate(anchors))
    _, fixed = _blocks(words, block)
    key = bucket_of(fixed[:, 1], n_buckets) << np.uint64(32) | (fixed[:, 1] & LOW)
    is_anchor = np.zeros(len(words.start) + block, dtype=bool)
    is_anchor[fixed[_within(key, anchor), 0].astype(np.int64)] = True
    place = _positions(words)
    at = np.flatnonzero(words.left() >= window)
    at = at[is_anchor[at + (-place[at]) % block]]
    hashes = window_hashes(words.hashes, window)
    return at, hashes[at] if len(at) else np.empty(0, dtype=np.uint64)


def _ask_windows(chunk: int, batch: pa.RecordBatch, answers: pa.Table, window: int, block: int,
                 n_buckets: int) -> dict:
    words = words_of(texts_of(batch))
    _, hashes = _candidates(words, answers, window, block, n_buckets)
    found, count = np.unique(hashes, return_counts=True)
    rows: dict[str, list] = {"bucket": [], "chunk": [], "probes": [], "twice": []}
    for bucket, piece in _pieces(found, n_buckets):
        rows["bucket"].append(bucket)
        rows["chunk"].append(chunk)
        rows["probes"].append(found[piece].astype("<u8").tobytes())
        rows["twice"].append(np.packbits(count[piece] > 1).tobytes())
    return rows


def _answer_windows(table: pa.Table) -> dict:
    """For each chunk, a bit for each of its windows: whether it occurs elsewhere."""
    probes = [numbers(v, "<u8") for v in table["probes"]]
    flat = np.concatenate(probes)
    found = np.sort(flat)
    hit = _within(flat, distinct(found[1:][found[1:] == found[:-1]]))
    data, at = [], 0
    for own, twice in zip(probes, table["twice"], strict=True):
        bits = np.unpackbits(numbers(twice, "u1"), count=len(own)).astype(bool)
        data.append(np.packbits(bits | hit[at:at + len(own)]).tobytes())
        at += len(own)
    return {"chunk": table["chunk"].to_pylist(), "bucket": table["bucket"].to_pylist(),
            "step": [1] * len(data), "data": data}


def _removed(words: Words, answers: pa.Table, window: int, block: int, n_buckets: int) -> np.ndarray:
    """For each word, whether a repeated window covers it."""
    at, hashes = _candidates(words, answers, window, block, n_buckets)
    found, which = np.unique(hashes, return_inverse=True)
    repeated = np.zeros(len(found), dtype=bool)
    bits = {b.as_py(): d for b, s, d in zip(answers["bucket"], answers["step"], answers["data"],
                                            strict=True) if s.as_py() == 1}
    for bucket, piece in _pieces(found, n_buckets):
        repeated[piece] = np.unpackbits(numbers(bits[bucket], "u1"),
                                        count=piece.stop - piece.start)
    start = at[repeated[which]]
    marks = np.zeros(len(words.start) + 1, dtype=np.int64)
    marks[start] += 1
    marks[start + window] -= 1
    return np.cumsum(marks[:-1]) > 0


def _kept(batch: pa.RecordBatch, removed: np.ndarray, words: Words,
          texts: list[bytes | None]) -> dict:
    totals = np.concatenate(([0], np.cumsum(removed)))
    n_removed = totals[words.first[1:]] - totals[words.first[:-1]]
    kept = []
    for i, text in enumerate(texts):
        if n_removed[i] == 0:
            kept.append(b" ".join((text or b"").split()))
        else:
            first, last = words.first[i], words.first[i + 1]
            kept.append(b" ".join(words.word(j) for j in (
                np.flatnonzero(~removed[first:last]) + first).tolist()))
    rest = {name: batch[name] for name in batch.schema.names if name != "text"}
    return rest | {"n_words": words.counts, "n_removed": n_removed,
                   "kept_text": pa.array(kept, pa.binary()).cast(pa.string())}


RESULT = StructType([StructField("n_words", LongType()), StructField("n_removed", LongType()),
                     StructField("kept_text", StringType())])


def drop_repeats(docs: DataFrame, text: str = "text", window: int = WINDOW,
                 keep: list[str] | None = None) -> DataFrame:
    """Remove from every whole text each word that a repeated window of words covers.

    A window is ``window`` consecutive words (runs of anything but blanks) of one text; it is
    repeated if its word sequence also starts anywhere else, in the same text included.  The
    columns ``keep`` (default: all but the text) stay; ``n_words``, ``n_removed`` and
    ``kept_text``, the kept words joined by one space, follow.

    1. *Index and probe.*  The non-overlapping blocks of ``block_size(window)`` words of all
       texts are the index; every rolling window of that many words probes it.  A block found
       at a second place is an anchor.
    2. *Extend.*  Only windows that hold an anchor can be repeated.  Their hashes over all
       ``window`` words are compared across the corpus; the union of the repeated ones are the
       maximal exact repeats.

    Both steps are an exchange of hashes (see :mod:`footfall.llm.exchange`): a passage in a third
    of all texts is one entry per chunk.  Step 1 ships four bytes a word, since a chance hit only
    costs a needless check; step 2 decides by 64 bits besides the bucket's.  No pairs of texts
    are formed.  A NULL text has no words; repeated rows are repeats of each other.
    """
    spark, block = docs.sparkSession, block_size(window)
    kept = [c for c in docs.columns if c != text] if keep is None else keep
    kept = others(kept, RESULT.names)
    rows = docs.select(*hidden(kept), F.col(text).alias("text"))
    fields = rows.drop("text").schema
    chunks = write_chunks(rows, "chunks")
    n_bytes = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    n_buckets = bucket_count(spark, n_bytes)
    shape = (window, block, n_buckets)

    anchors = write_aside(bucket_rows(
        chunk_rows(chunks, lambda chunk, batch: [_ask_blocks(chunk, batch, block, n_buckets)],
                   "bucket long, chunk long, probes binary, twice binary, index binary"),
        _answer_blocks, ANSWER), "anchors")
    release(spark)
    repeats = write_aside(bucket_rows(
        answered_rows(chunks, anchors,
                      lambda chunk, batch, answers: _ask_windows(chunk, batch, answers, *shape),
                      "bucket long, chunk long, probes binary, twice binary"),
        _answer_windows, ANSWER), "repeats")
    release(spark)

    def finish(chunk: int, batch: pa.RecordBatch, answers: pa.Table) -> dict:
        texts = texts_of(batch)
        words = words_of(texts)
        return _kept(batch, _removed(words, answers, *shape), words, texts)

    found = answered_rows(chunks, anchors.unionByName(repeats), finish,
                          StructType(list(fields.fields) + list(RESULT.fields)))
    return found.select(*shown(kept), *RESULT.names)
