"""Benchmark decontamination: Wu-Manber search for word windows of test items."""

from collections.abc import Iterable, Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from footfall.llm.exchange import hidden, others, shown, slices, texts_of
from footfall.llm.words import PLAIN, Words, mix, words_of
from footfall.scratch import write_aside

WINDOW = 10
#: Patterns of one pass, in bytes with their item ids; more patterns are searched in more passes.
PASS_BYTES = 32 << 20
TABLE_BITS = 18
SEGMENT = 256

RESULT = "n_words long, n_hit long, items array<string>, hit_from array<long>, hit_to array<long>"


@dataclass
class Patterns:
    """Shift and suffix tables of distinct patterns with ``length`` words each.

    ``block`` words make a block.  ``shift`` tells, by a block's hash, how far the search may
    jump when a window ends with that block: past every place where no pattern can end.  Where it
    is 0 the patterns whose last block has the hash (``suffix``, sorted) are compared.
    """

    length: int
    block: int
    shift: np.ndarray
    suffix: np.ndarray
    prefix: np.ndarray
    texts: list[bytes]
    items: list[list[str]]


def _block_hash(hashes: np.ndarray, end: np.ndarray, block: int) -> np.ndarray:
    """A hash of the ``block`` words that end with word ``end``."""
    if block == 1:
        return mix(hashes[end])
    return mix(hashes[end - 1] * np.uint64(3) + hashes[end])


def build_patterns(windows: Iterable[tuple[str, str]]) -> list[Patterns]:
    """One set of tables for each length; ``windows`` are (words joined by a space, item)."""
    by_length: dict[int, dict[bytes, set[str]]] = {}
    for text, item in windows:
        data = text.encode()
        by_length.setdefault(data.count(b" ") + 1, {}).setdefault(data, set()).add(item)
    return [_tables(length, found) for length, found in sorted(by_length.items())]


def _tables(length: int, found: dict[bytes, set[str]]) -> Patterns:
    texts = sorted(found)
    words = words_of(texts, PLAIN)
    block = min(2, length)
    firsts = words.first[:-1]
    shift = np.full(1 << TABLE_BITS, length - block + 1, dtype=np.uint8 if length < 255 else np.int64)
    for end in range(block - 1, length):
        at = _block_hash(words.hashes, firsts + end, block) & np.uint64((1 << TABLE_BITS) - 1)
        np.minimum.at(shift, at.astype(np.int64), length - 1 - end)
    suffix = _block_hash(words.hashes, firsts + length - 1, block)
    prefix = _block_hash(words.hashes, firsts + block - 1, block)
    order = np.argsort(suffix, kind="stable")
    return Patterns(length, block, shift, suffix[order], prefix[order],
                    [texts[i] for i in order], [sorted(found[texts[i]]) for i in order])


def occurrences(words: Words, patterns: Patterns) -> list[tuple[int, int]]:
    """Every (index of the first word, pattern) at which a pattern occurs within one text.

    The texts' possible window ends are cut into segments, and one cursor per segment runs
    through the shift table; all cursors step together.
    """
    counts, m, block = words.counts, patterns.length, patterns.block
    n_ends = np.maximum(counts - m + 1, 0)
    n_segments = -(-n_ends // SEGMENT)
    text = np.repeat(np.arange(len(counts)), n_segments)
    which = np.arange(len(text)) - np.repeat(np.cumsum(n_segments) - n_segments, n_segments)
    cursor = words.first[:-1][text] + m - 1 + which * SEGMENT
    limit = np.minimum(cursor + SEGMENT, words.first[1:][text])
    mask = np.uint64(len(patterns.shift) - 1)
    ends = []
    while len(cursor):
        jump = patterns.shift[
            (_block_hash(words.hashes, cursor, block) & mask).astype(np.int64)].astype(np.int64)
        ends.append(cursor[jump == 0])
        cursor = cursor + np.maximum(jump, 1)
        going = cursor < limit
        cursor, limit = cursor[going], limit[going]
    end = np.sort(np.concatenate(ends)) if ends else np.empty(0, dtype=np.int64)
    tail = _block_hash(words.hashes, end, block) if len(end) else np.empty(0, dtype=np.uint64)
    low = np.searchsorted(patterns.suffix, tail, "left")
    size = np.searchsorted(patterns.suffix, tail, "right") - low
    end, low = np.repeat(end, size), np.repeat(low, size)
    pattern = low + np.arange(len(end)) - np.repeat(np.cumsum(size) - size, size)
    if len(end):
        head = _block_hash(words.hashes, end - m + block, block)
        same = patterns.prefix[pattern] == head
        end, pattern = end[same], pattern[same]
    return [
        (int(e) - m + 1, int(p)) for e, p in zip(end, pattern, strict=True)
        if b" ".join(words.word(i) for i in range(e - m + 1, e + 1)) == patterns.texts[p]
    ]


def search(texts: list[bytes | None], sets: list[Patterns]) -> dict[str, list]:
    """The result columns for a batch of texts."""
    words = words_of(texts, PLAIN, lower=True)
    marks = np.zeros(len(words.start) + 1, dtype=np.int64)
    items: list[set[str]] = [set() for _ in texts]
    for patterns in sets:
        found = occurrences(words, patterns)
        if found:
            at = np.array([start for start, _ in found])
            np.add.at(marks, at, 1)
            np.add.at(marks, at + patterns.length, -1)
            of = np.searchsorted(words.first, at, side="right") - 1
            for text, (_, pattern) in zip(of, found, strict=True):
                items[text].update(patterns.items[pattern])
    hit = np.cumsum(marks[:-1]) > 0
    totals = np.concatenate(([0], np.cumsum(hit)))
    out: dict[str, list] = {"n_words": words.counts.tolist(),
                            "n_hit": (totals[words.first[1:]] - totals[words.first[:-1]]).tolist(),
                            "items": [sorted(i) for i in items], "hit_from": [], "hit_to": []}
    for text, n in enumerate(out["n_hit"]):
        begin, end = [], []
        if n:
            own = hit[words.first[text]:words.first[text + 1]].astype(np.int8)
            steps = np.diff(np.concatenate(([0], own, [0])))
            begin, end = np.flatnonzero(steps == 1).tolist(), np.flatnonzero(steps == -1).tolist()
        out["hit_from"].append(begin)
        out["hit_to"].append(end)
    return out


def item_windows(benchmark: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """Distinct (window, item): ``window`` consecutive words, or all words of a shorter item."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = []
                words = words_of(texts_of(part), PLAIN, lower=True)
                for name, first, last in zip(part["item"].to_pylist(), words.first[:-1],
                                             words.first[1:], strict=True):
                    own = [words.word(i) for i in range(first, last)]
                    rows += [(b" ".join(own[i:i + window]), name)
                             for i in range(max(1, len(own) - window + 1)) if own]
                yield pa.RecordBatch.from_pydict({
                    "window": pa.array([r[0] for r in rows], pa.binary()).cast(pa.string()),
                    "item": pa.array([r[1] for r in rows], pa.string())})

    named = benchmark.select(
        F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))
    return named.mapInArrow(cut, "window string, item string").distinct()


def _pass(docs: DataFrame, windows: DataFrame, kept: list[str]) -> DataFrame:
    """One search of ``docs``; ``windows`` is of bounded size, see :func:`contamination`."""
    spark = docs.sparkSession
    names = [f"_k{i}" for i in range(len(kept))]
    built = build_patterns((row.window, row.item) for row in windows.toLocalIterator())
    sets = spark.sparkContext.broadcast([astuple(patterns) for patterns in built])
    fields = docs.select(*names).schema
    result = StructType.fromDDL(RESULT)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        columns = to_arrow_schema(result)
        patterns = [Patterns(*values) for values in sets.value]
        for batch in batches:
            for part in slices(batch, text="_text"):
                found = pa.RecordBatch.from_pydict(search(texts_of(part, "_text"), patterns),
                                                   schema=columns)
                rest = part.drop_columns(["_text"])
                yield pa.RecordBatch.from_arrays(rest.columns + found.columns,
                                                 rest.schema.names + found.schema.names)

    found = docs.select(*names, "_text").mapInArrow(
        run, StructType(list(fields.fields) + list(result.fields)))
    return found.select(*shown(kept), *result.names)


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, keep: list[str] | None = None,
                  pass_bytes: int = PASS_BYTES) -> DataFrame:
    """Find test items in documents; the columns ``keep`` (default: all) stay, and five follow.

    A-Z are lower-cased; words are runs of digits, a-z and characters beyond ASCII.  A pattern is
    ``window`` consecutive words of an item, or all words of a shorter item that has any.
    ``n_words`` counts a document's words, ``n_hit`` those inside any occurrence of a pattern,
    ``items`` holds the sorted ids (as text) of the items whose patterns occur, and ``hit_from``,
    ``hit_to`` are the runs of hit words.

    Documents are searched where they lie: no shuffle, so no hot key.  The patterns go to every
    task as one broadcast of at most about ``pass_bytes``.  A larger benchmark is dealt by hash
    into several such parts and the documents, written once with row numbers, are searched once
    per part; the runs and items found are then merged per row.

    A NULL or empty text has no words; a NULL item id counts as the empty text; repeated rows
    are judged one by one; columns named like a result column are replaced.  An empty benchmark
    hits nothing.
    """
    names = [n.split()[0] for n in RESULT.split(",")]
    kept = others(docs.columns if keep is None else keep, names)
    rows = docs.select(*hidden(kept), F.col(text).alias("_text"))
    windows = write_aside(item_windows(benchmark, item, item_text, window), "windows")
    n_bytes = windows.agg(F.sum(F.length("window") + F.length("item") + 64)).first()[0] or 0
    parts = -(-int(n_bytes) // pass_bytes)
    if parts <= 1:
        return _pass(rows, windows, kept)
    rows = write_aside(rows.withColumn("_row", F.monotonically_increasing_id()), "documents")
    found = None
    for number in range(parts):
        part = windows.where(F.pmod(F.xxhash64("window", "item"), F.lit(parts)) == number)
        one = _pass(rows.select(F.col("_row").alias("_k0"), "_text"), part, ["_row"])
        found = one if found is None else found.unionByName(one)
    merged = found.groupBy("_row").agg(
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("items")).alias("items"),
        F.flatten(F.collect_list(F.arrays_zip("hit_from", "hit_to"))).alias("runs"),
    )
    empty = F.array().cast("array<struct<a:bigint,b:bigint>>")
    runs = F.aggregate(
        F.array_sort("runs"), empty,
        lambda acc, run: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["b"] >= run["hit_from"]),
            F.array_append(F.slice(acc, 1, F.size(acc) - 1), F.struct(
                F.element_at(acc, -1)["a"].alias("a"),
                F.greatest(F.element_at(acc, -1)["b"], run["hit_to"]).alias("b")))
        ).otherwise(F.array_append(acc, F.struct(run["hit_from"].alias("a"),
                                                 run["hit_to"].alias("b")))))
    merged = merged.select("_row", "n_words", "items", runs.alias("runs"))
    zero = F.lit(0).cast("long")
    return rows.join(merged, "_row", "left").select(
        *shown(kept), F.coalesce("n_words", zero).alias("n_words"),
        F.coalesce(F.aggregate("runs", zero, lambda acc, r: acc + r["b"] - r["a"]), zero)
        .alias("n_hit"),
        F.coalesce(F.array_sort(F.array_distinct("items")), F.array().cast("array<string>"))
        .alias("items"),
        F.coalesce(F.transform("runs", lambda r: r["a"]), F.array().cast("array<bigint>"))
        .alias("hit_from"),
        F.coalesce(F.transform("runs", lambda r: r["b"]), F.array().cast("array<bigint>"))
        .alias("hit_to"),
    )
