"""MinHash near-dedup: an inverted join over signature coordinates, confirmed on full sets."""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from footfall.llm.exchange import (
    answered_rows, bucket_count, bucket_cuts, bucket_rows, chunk_rows, numbers, packed, release, slices,
    texts_of, unpacked, write_blobs, write_chunks,
)
from footfall.llm.graph import components
from footfall.llm.words import mix, whole_hashes, window_hashes, words_of
from footfall.scratch import write_aside

SHINGLE = 5
SIMILARITY = 75
COORDINATES = 128
#: Equal coordinates from which a pair is compared in full.  At a similarity of 0.75 the number is
#: binomial (128, 0.75): mean 96, and below 72 with a probability of 1.2e-6, once in some 830 000
#: pairs; at 0.76 of 2.9e-7.
MATCHES = 72
#: All members of lists of up to so many meet at once; of longer ones all meet the most central one.
SHORT = 4
#: Sets that are compared together: so many, with so many shingles in all (a larger set is alone).
BLOCK_SETS, BLOCK_SHINGLES = 256, 1 << 18
#: Shingles whose holders are counted at once.
COLUMNS = 4096

_SEEDS = mix(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
FACTORS, SHIFTS = _SEEDS[:COORDINATES] | np.uint64(1), _SEEDS[COORDINATES:]


def shingle_sets(texts: list[bytes | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order, and where each text's begin.

    A text with fewer than ``size`` words, but not none, has one: all its words.
    """
    words = words_of(texts, lower=True)
    rolling = window_hashes(words.hashes, size)
    inside = words.left()[:len(rolling)] >= size
    text, shingle = words.text_of()[:len(rolling)][inside], rolling[inside]
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    text = np.concatenate((text, short))
    shingle = np.concatenate((shingle, whole_hashes(words)[short]))
    order = np.lexsort((shingle, text))
    text, shingle = text[order], shingle[order]
    if len(text):
        new = np.concatenate(([True], (text[1:] != text[:-1]) | (shingle[1:] != shingle[:-1])))
        text, shingle = text[new], shingle[new]
    return shingle, np.searchsorted(text, np.arange(len(texts) + 1))


def _signatures(shingle: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """One row of minima (uint32) per text that has shingles."""
    out = np.empty((len(begins), COORDINATES), dtype="<u4")
    for k in range(COORDINATES):
        hashed = (shingle * FACTORS[k] + SHIFTS[k]) >> np.uint64(32)
        out[:, k] = np.minimum.reduceat(hashed, begins)
    return out


SKETCH = StructType([StructField("n_shingles", LongType()), StructField("_set", BinaryType()),
                     StructField("_sig", BinaryType()), StructField("_low", BinaryType())])


def sketches(docs: DataFrame, text: str, keep: list[str], size: int = SHINGLE) -> DataFrame:
    """``keep`` and, of the whole text: the size of its shingle set, a 128-bit name of the set
    (NULL if empty), its MinHash signature and the signature's low bytes."""
    fields = docs.select(*keep).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text="_text"):
                shingle, begins = shingle_sets(texts_of(part, "_text"), size)
                counts = np.diff(begins)
                full = np.flatnonzero(counts)
                names: list[bytes | None] = [None] * part.num_rows
                sigs: list[bytes | None] = [None] * part.num_rows
                lows: list[bytes | None] = [None] * part.num_rows
                if len(full):
                    at = begins[full]
                    one = np.add.reduceat(mix(shingle ^ np.uint64(0x5851F42D4C957F2D)), at)
                    two = np.bitwise_xor.reduceat(mix(shingle + np.uint64(0x14057B7EF767814F)), at)
                    pairs = np.column_stack((one, two)).astype("<u8")
                    rows = _signatures(shingle, at)
                    for i, pair, row in zip(full.tolist(), pairs, rows, strict=True):
                        names[i], sigs[i] = pair.tobytes(), row.tobytes()
                        lows[i] = row.astype("u1").tobytes()
                rest = part.drop_columns(["_text"])
                yield pa.RecordBatch.from_arrays(
                    [*rest.columns, pa.array(counts, pa.int64()), pa.array(names, pa.binary()),
                     pa.array(sigs, pa.binary()), pa.array(lows, pa.binary())], [*rest.schema.names, *SKETCH.names])

    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(
        run, StructType(list(fields.fields) + list(SKETCH.fields)))


def _coordinate_keys(batch: pa.RecordBatch) -> np.ndarray:
    """One key per class and coordinate: the coordinate's number and value, hashed."""
    values = np.frombuffer(b"".join(texts_of(batch)), dtype="<u4").reshape(-1, COORDINATES)
    numbered = values.astype(np.uint64) | (np.arange(COORDINATES, dtype=np.uint64) << np.uint64(32))
    return mix(numbered + np.uint64(0x2545F4914F6CDD1D))


def _shingle_keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of each class, and where each one's begin."""
    shingle, begins = shingle_sets(texts_of(batch), int(batch["shingle"][0].as_py()))
    return mix(shingle), begins


def _keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    if "shingle" in batch.schema.names:
        return _shingle_keys(batch)
    keys = _coordinate_keys(batch)
    return keys.ravel(), np.arange(len(keys) + 1) * COORDINATES


def _ask_frequencies(chunk: int, batch: pa.RecordBatch, n_buckets: int) -> dict:
    found, count = np.unique(_keys(batch)[0], return_counts=True)
    cuts = bucket_cuts(found, n_buckets)
    rows: dict[str, list] = {"bucket": [], "chunk": [], "keys": [], "counts": []}
    for bucket in np.flatnonzero(np.diff(cuts)).tolist():
        piece = slice(cuts[bucket], cuts[bucket + 1])
        rows["bucket"].append(bucket)
        rows["chunk"].append(chunk)
        rows["keys"].append(found[piece].astype("<u8").tobytes())
        rows["counts"].append(count[piece].astype("<u4").tobytes())
    return rows


def _answer_frequencies(table: pa.Table) -> dict:
    keys = [numbers(v, "<u8") for v in table["keys"]]
    found, which = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(which, np.concatenate([numbers(v, "<u4") for v in table["counts"]]))
    ends = np.cumsum([len(k) for k in keys])
    data = [total[which[e - len(k):e]].astype("<u8").tobytes()
            for e, k in zip(ends, keys, strict=True)]
    return {"chunk": table["chunk"].to_pylist(), "bucket": table["bucket"].to_pylist(), "data": data}


def _rare_postings(chunk: int, batch: pa.RecordBatch, answers: pa.Table, n_buckets: int) -> dict:
    """Of each class the rarest keys, as many as its prefix has, in one order for all classes,
    without those that no other class has."""
    keys, begins = _keys(batch)
    found, which = np.unique(keys, return_inverse=True)
    cuts = bucket_cuts(found, n_buckets)
    known = np.zeros(len(found), dtype=np.int64)
    for bucket, data in zip(answers["bucket"].to_pylist(), answers["data"], strict=True):
        known[cuts[bucket]:cuts[bucket + 1]] = numbers(data, "<u8")
    count, sizes = known[which], np.diff(begins)
    of = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((keys, count, of))
    prefix = batch["prefix"].to_numpy()
    place = np.arange(len(keys)) - np.repeat(begins[:-1], sizes)
    order = order[place < prefix[of]]
    order = order[count[order] > 1]
    at = pa.array(of[order])
    total = np.add.reduceat(count, begins[:-1])
    return {"post": keys[order].view(np.int64), "size": count[order],
            **{name: batch[name].take(at) for name in ("key", "n", "rank")},
            "central": total[of[order]]}


def postings(classes: DataFrame) -> DataFrame:
    """Posting lists: classes (key, with the size n of the set) under their rarest keys (post, with
    the list's size); central adds up the sizes of all lists of the class.

    ``classes`` has a column ``text`` with the signature, whose keys are its coordinate-value
    pairs, or, if there is a column ``shingle``, with the text, whose keys are its shingles; and
    a column ``prefix`` with the number of keys to post.
    """
    spark = classes.sparkSession
    chunks = write_chunks(classes, "signatures")
    size = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    n_buckets = bucket_count(spark, 2 * size)
    answers = write_aside(bucket_rows(
        chunk_rows(chunks, lambda chunk, batch: [_ask_frequencies(chunk, batch, n_buckets)],
                   "bucket long, chunk long, keys binary, counts binary"),
        _answer_frequencies, "chunk long, bucket long, data binary"), "frequencies")
    release(spark)
    return write_aside(answered_rows(
        chunks, answers, lambda chunk, batch, own: _rare_postings(chunk, batch, own, n_buckets),
        "post long, size long, key long, n long, rank long, central long"), "postings")


def _match(pairs: DataFrame, classes: DataFrame, matches: int) -> DataFrame:
    """The pairs (a, b) whose signatures agree in ``matches`` coordinates or more, with how many.

    Signatures are compared by their low bytes; a chance agreement can only let a pair through.
    """
    small = classes.select("key", F.col("low").alias("sig"))
    both = (
        pairs.join(small.withColumnsRenamed({"key": "a", "sig": "sig_a"}), "a")
        .join(small.withColumnsRenamed({"key": "b", "sig": "sig_b"}), "b")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch[c].to_pylist()), dtype="u1")
                        .reshape(-1, COORDINATES) for c in ("sig_a", "sig_b"))
            equal = (one == two).sum(axis=1)
            keep = pa.array(equal >= matches)
            yield pa.RecordBatch.from_arrays(
                [batch["a"].filter(keep), batch["b"].filter(keep),
                 pa.array(equal, pa.int64()).filter(keep)], ["a", "b", "n"])

    return both.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long, n long")


def _confirm(pairs: DataFrame, texts: DataFrame, size: int, similarity: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""
    both = (
        pairs.select("a", "b")
        .join(texts.withColumnsRenamed({"key": "a", "text": "text_a"}), "a")
        .join(texts.withColumnsRenamed({"key": "b", "text": "text_b"}), "b")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text="text_a", limit=1 << 20):
                n = part.num_rows
                shingle, begins = shingle_sets(texts_of(part, "text_a") + texts_of(part, "text_b"),
                                               size)
                sizes = np.diff(begins)
                of = np.repeat(np.arange(2 * n) % n, sizes)
                order = np.lexsort((shingle, of))
                of, shingle = of[order], shingle[order]
                same = (of[1:] == of[:-1]) & (shingle[1:] == shingle[:-1])
                common = np.bincount(of[1:][same], minlength=n)
                union = sizes[:n] + sizes[n:] - common
                keep = pa.array((100 * common >= similarity * union) & (union > 0))
                yield pa.RecordBatch.from_arrays(
                    [part["a"].filter(keep), part["b"].filter(keep)], ["a", "b"])

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _across(pairs: DataFrame, found: DataFrame | None) -> DataFrame:
    """The pairs whose ends are not known to be in one component."""
    if found is None:
        return pairs
    for end in ("a", "b"):
        pairs = (
            pairs.join(found.withColumnsRenamed({"node": end, "component": f"c{end}"}), end, "left")
            .withColumn(f"c{end}", F.coalesce(f"c{end}", end))
        )
    return pairs.where("ca != cb").drop("ca", "cb")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id",
                    size: int = SHINGLE, similarity: int = SIMILARITY,
                    matches: int = MATCHES) -> DataFrame:
    """Link documents whose sets of word shingles have a Jaccard similarity of ``similarity``
    percent or more; one row per row of ``docs``.

    Words are runs of anything but blanks, A-Z lower-cased.  ``n_shingles`` is the size of the
    set, ``component_id`` the smallest key reachable by links and ``kept`` whether that is the
    document's own.

    1. Documents with the same set are one class, whose links its smallest key stands for.
    2. A class is posted under the coordinate-value pairs of its MinHash signature.  Two classes
       that agree in ``matches`` of the coordinates share one of the rarest ones, so only that
       prefix is posted, and lists with one member are left out.  Pairs that many documents share
       for a common passage are thereby skipped; they are counted by comparing signatures.
    3. In a short list all members meet; in a longer one first all meet the most central one,
       whose lists are the longest, such as what the others were copied from.  Only members
       of sizes that allow the similarity meet.  Pairs with enough collisions are confirmed on
       their full sets.  Members that links join need not meet again.
    4. Members of lists that still hold several components are posted anew under their rarest
       shingles, an exact filter that parts documents with a common passage from near copies, and
       meet as before, now without the test of signatures.
    5. What is still apart in these lists is compared in full, block with block: a block holds
       the sets of documents of one size class and mostly one list, a task counts the common
       shingles of all pairs of two blocks at once, and links that join components go on, at most
       one for each document.  So many documents that look alike but are not similar enough
       cost time within tasks and no rows, and no link between components is lost but by the
       chance that ``matches`` allows for.

    A text without words links with nothing, nor does a row with a NULL key, which is kept and
    has no component.  Keys are whole numbers; rows with
    the same key are one document.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_words"))
    rows = rows.withColumn("_tag", F.xxhash64("_words"))
    sketch = write_aside(sketches(rows, "_words", ["_key", "_tag"], size), "sketches")
    found = _components(spark, sketch, rows, size, similarity, matches)
    release(spark)
    own = (F.col("n_shingles") == 0) | F.col("_key").isNull()
    full = (
        sketch.where(~own).select("_key", "n_shingles", "_set").join(found, "_set")
        .select("_key", "n_shingles", "component_id")
    )
    empty = sketch.where(own).select("_key", "n_shingles", F.col("_key").alias("component_id"))
    return full.unionByName(empty).select(
        F.col("_key").alias(key), "n_shingles", "component_id",
        F.coalesce(F.col("_key") == F.col("component_id"), F.lit(True)).alias("kept"))


def _components(spark: SparkSession, sketch: DataFrame, rows: DataFrame, size: int, similarity: int,
                matches: int) -> DataFrame:
    """(_set, component_id) of every class."""
    classes = write_aside(
        sketch.where(F.col("_set").isNotNull() & F.col("_key").isNotNull())
        .groupBy("_set").agg(F.min(F.struct("_key", "_tag")).alias("least"),
                             F.min("n_shingles").alias("n"),
                             F.min("_sig").alias("sig"), F.min("_low").alias("low"))
        .select("_set", F.col("least._key").alias("key"), F.col("least._tag").alias("tag"), "n", "sig",
                "low", F.xxhash64("_set").alias("rank")), "classes")
    lists = postings(classes.select(
        "key", "rank", "n", F.col("sig").alias("text"),
        F.lit(COORDINATES - matches + 1).cast("long").alias("prefix")))
    found = None

    def join(links: DataFrame) -> None:
        nonlocal found
        if not links.isEmpty():
            found = _joined(found, links)
        release(spark)

    def meet(lists: DataFrame, by_signature: bool) -> None:
        pairs = write_aside(_meeting(_with_components(lists, found), similarity), "met")
        likely = _across(pairs, found)
        if by_signature:
            likely = _match(likely, classes, matches)
        likely = write_aside(likely, "pairs")
        ends = likely.select(F.col("a").alias("key")).unionByName(
            likely.select(F.col("b").alias("key"))).distinct()
        texts = write_aside(_texts(rows, classes, ends), "texts")
        join(write_aside(_confirm(likely, texts, size, similarity), "links"))

    lists = _different(lists, found)
    meet(lists, by_signature=True)
    lists = _apart(lists, found)
    if lists is not None:
        lists = _different(_refined(lists, rows, classes, size, similarity), found)
        meet(lists, by_signature=False)
        lists = _apart(lists, found)
    if lists is not None:
        join(write_aside(_block_links(lists, found, rows, classes, size, similarity), "links"))
    if found is None:
        return classes.select("_set", F.col("key").alias("component_id"))
    return write_aside(
        classes.select("_set", "key")
        .join(found, F.col("key") == F.col("node"), "left")
        .select("_set", F.coalesce("component", "key").alias("component_id")), "classes")


def _joined(found: DataFrame | None, links: DataFrame) -> DataFrame:
    """The components after more links: these join components, of which there are fewer."""
    if found is None:
        return write_aside(components(links), "components")
    ends = links
    for end in ("a", "b"):
        ends = (
            ends.join(found.withColumnsRenamed({"node": end, "component": f"c{end}"}), end, "left")
            .withColumn(end, F.coalesce(f"c{end}", end)).drop(f"c{end}")
        )
    merged = write_aside(components(ends), "components")
    renamed = merged.select(F.col("node").alias("component"), F.col("component").alias("root"))
    old = found.join(renamed, "component", "left").select(
        "node", F.coalesce("root", "component").alias("component"))
    return write_aside(
        old.unionByName(merged.join(found, "node", "left_anti")), "components")


def _with_components(lists: DataFrame, found: DataFrame | None) -> DataFrame:
    if found is None:
        return lists.withColumn("component", F.col("key"))
    return lists.join(found.withColumnRenamed("node", "key"), "key", "left").withColumn(
        "component", F.coalesce("component", "key"))


def _apart(lists: DataFrame, found: DataFrame | None) -> DataFrame | None:
    """The postings of lists that hold several components and members that did not meet."""
    left = _different(lists.where(F.col("size") > SHORT), found)
    return None if left.isEmpty() else left


def _different(lists: DataFrame, found: DataFrame | None) -> DataFrame:
    """Lists that hold several components, and of lists with the same members only one.

    Documents that share a long passage or are copies of each other are together in many lists.
    """
    members = _with_components(lists, found).groupBy("post").agg(
        (F.min("component") != F.max("component")).alias("apart"), F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("key").cast("decimal(20,0)")).alias("h1"),
        F.sum(F.xxhash64(F.lit(1), "key").cast("decimal(20,0)")).alias("h2"))
    one = members.where("apart").groupBy("n", "h1", "h2").agg(F.min("post").alias("post"))
    return write_aside(
        lists.join(write_aside(one.select("post"), "chosen"), "post", "left_semi"), "live")


def _refined(lists: DataFrame, rows: DataFrame, classes: DataFrame, size: int,
             similarity: int) -> DataFrame:
    """Posting lists of the members of ``lists`` under their rarest shingles.

    Sets of n shingles that share enough share one of the n - ceil(similarity * n) + 1 that are
    rarest among all members, so nothing is lost; members that only have a common passage, though
    a long one, share none.
    """
    members = lists.select("key", "n", "rank").distinct()
    texts = _texts(rows, classes, members.select("key"))
    need = F.ceil(F.col("n") * similarity / 100)
    return postings(members.join(texts, "key").select(
        "key", "rank", "n", "text", F.lit(size).alias("shingle"),
        (F.col("n") - need + 1).cast("long").alias("prefix")))


def _meeting(live: DataFrame, similarity: int) -> DataFrame:
    """Pairs (a, b) of a member of a list and a hub, of different components.

    All members of short lists are hubs and the most central one of others.
    """
    central = live.where(F.col("size") > SHORT).groupBy("post").agg(
        F.max(F.struct("central", "key", "n", "component")).alias("top"))
    hubs = (
        live.where(F.col("size") <= SHORT)
        .select("post", F.col("key").alias("hub"), F.col("n").alias("hub_n"), F.col("component").alias("of"))
        .unionByName(central.select("post", F.col("top.key").alias("hub"), F.col("top.n").alias("hub_n"),
                                    F.col("top.component").alias("of")))
    )
    hubs = write_aside(hubs, "hubs").withColumnRenamed("post", "list")
    met = live.join(hubs, (F.col("post") == F.col("list")) & (F.col("component") != F.col("of"))
                    & (100 * F.least("n", "hub_n") >= similarity * F.greatest("n", "hub_n")))
    return met.select(F.least("key", "hub").alias("a"), F.greatest("key", "hub").alias("b")).distinct()


def _block_links(lists: DataFrame, found: DataFrame | None, rows: DataFrame, classes: DataFrame, size: int,
                 similarity: int) -> DataFrame:
    """Links (a, b) that join components, of all pairs of members that share a list.

    A document goes to a block of its longest list and its size class.  Similar sets are of the same or
    of neighbouring classes, as a class reaches up to the size that the similarity allows for.
    Blocks meet where a list has members of both, unless all are of one component.
    """
    lists = _with_components(lists, found)
    members = lists.groupBy("post").agg(F.count(F.lit(1)).alias("members"))
    step = float(np.log(100 / similarity)) or 1.0
    kind = F.floor(F.log(F.col("n").cast("double")) / step + 1e-9).cast("int")
    homes = lists.join(members, "post").groupBy("key").agg(
        F.max(F.struct("members", "post")).alias("home"), F.first("n").alias("n"), F.first("rank").alias("rank"),
        F.first("component").alias("component")).withColumn("kind", kind)
    group = ["home", "kind"]
    most = F.greatest(F.lit(1), F.least(F.lit(BLOCK_SETS), F.floor(F.lit(BLOCK_SHINGLES) / F.max("n"))))
    parts = homes.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / most).alias("parts"))
    placed = write_aside(
        homes.join(parts, group).select(
            "key", "n", "kind", "component",
            F.xxhash64("home", "kind", F.pmod("rank", "parts")).alias("block")), "placed")
    blocks = placed.groupBy("block").agg(
        F.first("kind").alias("kind"), F.min("component").alias("low"), F.max("component").alias("high"))
    within = lists.select("post", "key").join(placed.select("key", "block"), "key").select(
        "post", "block").distinct().join(blocks, "block")
    one, two = (within.select("post", *(F.col(c).alias(f"{c}_{end}") for c in ("block", "kind", "low", "high")))
                for end in "ab")
    pairs = one.join(two, "post").where(
        "block_a <= block_b AND abs(kind_a - kind_b) <= 1"
        " AND NOT (low_a = high_a AND low_b = high_b AND low_a = low_b)"
    ).select("block_a", "block_b").distinct()
    texts = _texts(rows, classes, placed.select("key"))
    sets = write_blobs(_set_blocks(placed.join(texts, "key"), size), "blocks")
    both = (
        write_aside(pairs, "meeting").join(sets.withColumnsRenamed({"block": "block_a", "data": "one"}), "block_a")
        .join(sets.withColumnsRenamed({"block": "block_b", "data": "two"}), "block_b")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, one, two in zip(*(batch[c] for c in ("block_a", "block_b", "one", "two")), strict=True):
                left = unpacked(one.as_buffer())
                right = None if a == b else unpacked(two.as_buffer())
                yield pa.RecordBatch.from_pydict(dict(zip("ab", _forest(left, right, similarity), strict=True)))

    return both.select("block_a", "block_b", "one", "two").mapInArrow(run, "a long, b long")


def _set_blocks(rows: DataFrame, size: int) -> DataFrame:
    """A row for each block: its members' keys, components and sets, packed."""

    def run(table: pa.Table) -> pa.Table:
        keys, components, sets = [], [], []
        for batch in table.select(["key", "component", "text"]).to_batches():
            for part in slices(batch, limit=1 << 20):
                shingle, begins = shingle_sets(texts_of(part), size)
                keys.append(part["key"])
                components.append(part["component"])
                sets.append(pa.LargeListArray.from_arrays(pa.array(begins, pa.int64()), pa.array(shingle)))
        block = pa.RecordBatch.from_arrays(
            [pa.concat_arrays(keys), pa.concat_arrays(components), pa.concat_arrays(sets)],
            ["key", "component", "set"])
        return pa.table({"block": table["block"][:1], "data": pa.array([packed(block)], pa.binary())})

    return rows.select("block", "key", "component", "text").groupBy("block").applyInArrow(
        run, "block long, data binary")


def _flat(block: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All shingles of a block's sets, the member each is of, and the sizes of the sets."""
    sizes = np.diff(np.asarray(block["set"].offsets))
    return block["set"].flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes), sizes


def common_shingles(left: pa.RecordBatch, right: pa.RecordBatch) -> np.ndarray:
    """How many shingles each set of the one block has in common with each of the other.

    Only shingles of both blocks count; the matrices of some thousand of them at a time are multiplied.
    """
    (one, of_one, sizes_one), (two, of_two, sizes_two) = _flat(left), _flat(right)
    shared = np.intersect1d(one, two)
    found = np.zeros((len(sizes_one), len(sizes_two)), dtype=np.float32)
    sides = []
    for shingle, of, sizes in ((one, of_one, sizes_one), (two, of_two, sizes_two)):
        column = np.searchsorted(shared, shingle)
        known = column < len(shared)
        known[known] = shared[column[known]] == shingle[known]
        order = np.argsort(column[known], kind="stable")
        sides.append((column[known][order], of[known][order], len(sizes)))
    for begin in range(0, len(shared), COLUMNS):
        has = []
        for column, of, n in sides:
            part = slice(*np.searchsorted(column, (begin, begin + COLUMNS)))
            matrix = np.zeros((n, min(COLUMNS, len(shared) - begin)), dtype=np.float32)
            matrix[of[part], column[part] - begin] = 1
            has.append(matrix)
        found += has[0] @ has[1].T
    return np.rint(found).astype(np.int64)


def _forest(left: pa.RecordBatch, right: pa.RecordBatch | None, similarity: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between members of two blocks (or of one) that join components not joined before."""
    other = right if right is not None else left
    common = common_shingles(left, other)
    sizes = [np.diff(np.asarray(block["set"].offsets)) for block in (left, other)]
    union = sizes[0][:, None] + sizes[1][None, :] - common
    one, two = left["component"].to_numpy(), other["component"].to_numpy()
    linked = (100 * common >= similarity * union) & (union > 0) & (one[:, None] != two[None, :])
    root: dict[int, int] = {}

    def find(node: int) -> int:
        while (above := root.get(node, node)) != node:
            root[node] = root.get(above, above)
            node = above
        return node

    links = []
    for i, j in np.argwhere(linked).tolist():
        a, b = find(int(one[i])), find(int(two[j]))
        if a != b:
            root[max(a, b)] = min(a, b)
            links.append((i, j))
    at = np.array(links, dtype=np.int64).reshape(-1, 2)
    a, b = left["key"].to_numpy()[at[:, 0]], other["key"].to_numpy()[at[:, 1]]
    return np.minimum(a, b), np.maximum(a, b)


def _texts(rows: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, text) of wanted classes: the text of the row with the class's key."""
    chosen = classes.join(wanted, "key").select(F.col("key").alias("_key"), F.col("tag").alias("_tag"))
    return (
        rows.join(chosen, ["_key", "_tag"]).groupBy(F.col("_key").alias("key"))
        .agg(F.first("_words").alias("text"))
    )
