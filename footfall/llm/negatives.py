"""Hard negatives by exact integer inner products, many at a time.

Kronecker packing: a block's candidates are written side by side into one wide integer for each
component, every component in a field of its own and raised by a bias so that no field is
negative.  An anchor's component times such an integer multiplies the component of all candidates
at once; the sum over components holds all inner products, each in its field, and fields are wide
enough that none runs over.

Anchors against candidates is a grid of tiles: a bounded block of anchors meets a bounded block of
candidates, and a tile's work grows with the product of what is shipped for it.  A task keeps the
best of each anchor over all its tiles, so what it sends on does not grow with the candidates.
"""

from collections.abc import Callable, Iterable, Iterator
from operator import mul

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.exchange import packed, release, unpacked, write_blobs
from footfall.llm.lookup import begins, ranges
from footfall.scratch import write_aside

#: Components (8 bytes each) that a block of candidates and one of anchors hold.
BLOCK_BYTES = 2 << 20
ANCHOR_BYTES = 4 << 20
#: Candidates that one task compares with a block of anchors, where there are very many.
GROUP_ROWS = 1 << 18
#: Inner products stay below this.
SCORE_LIMIT = 1 << 62

POINT = "id long, label string, length int, components binary"


def integers(vectors: pa.ListArray, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length, the rows with components that all are finite, and floor(scale * component).

    Rows whose inner products might not be below ``SCORE_LIMIT`` are left out.
    """
    lengths = np.asarray(pc.fill_null(pc.list_value_length(vectors), -1), dtype=np.int64)
    first = begins(np.maximum(lengths, 0))
    raw = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore", invalid="ignore"):
        found = np.floor(scale * raw)
        fits = np.isfinite(found) & (np.abs(found) * np.abs(found) *
                                     np.repeat(np.maximum(lengths, 0), np.maximum(lengths, 0)) < SCORE_LIMIT)
    wrong = np.diff(begins(~fits)[first])
    for length in np.unique(lengths[(lengths >= 0) & (wrong == 0)]).tolist():
        rows = np.flatnonzero((lengths == length) & (wrong == 0))
        at = ranges(first[rows], np.full(len(rows), length))
        yield rows, found[at].astype(np.int64).reshape(len(rows), length)


class PackedBlock:
    """Candidates' components, a wide integer for each place, for anchors whose components sum up to
    ``largest`` at most without signs."""

    def __init__(self, values: np.ndarray, largest: int) -> None:
        self.n = len(values)
        self.bias = int(np.abs(values).max(initial=0))
        bits = (2 * self.bias * largest).bit_length()
        self.width = next(w for w in (4, 8, 16) if bits <= 8 * w)
        self.words = [self._wide(column + self.bias) for column in values.T]
        self.ones = self._wide(np.ones(self.n, dtype=np.int64))

    def _wide(self, fields: np.ndarray) -> int:
        low = np.zeros((len(fields), max(1, self.width // 8)), dtype="<u4" if self.width == 4 else "<u8")
        low[:, 0] = fields
        return int.from_bytes(low.tobytes(), "little")

    def scores(self, anchor: list[int]) -> np.ndarray:
        """The inner product with each candidate.

        A field holds it plus the bias times the anchor's sum; the bias times what negative
        components take from that sum is added, so that every field is at least 0.
        """
        plain = sum(map(abs, anchor))
        total = sum(map(mul, anchor, self.words)) + self.ones * (self.bias * (plain - sum(anchor)))
        raw = total.to_bytes(self.n * self.width, "little")
        if self.width == 4:
            return np.frombuffer(raw, dtype="<u4").astype(np.int64) - self.bias * plain
        low = np.frombuffer(raw, dtype="<u8")[::self.width // 8]
        return (low - np.uint64(self.bias * plain % (1 << 64))).view(np.int64)


class Best:
    """The first ``n`` rows of several rankings, by falling score, then rising id."""

    def __init__(self, n_rankings: int, n: int) -> None:
        self.n = n
        self.least = np.full(n_rankings, -SCORE_LIMIT, dtype=np.int64)
        self.found: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def add(self, ranking: int, scores: np.ndarray, ids: np.ndarray) -> None:
        some = scores >= self.least[ranking]
        if not some.any():
            return
        scores, ids = scores[some], ids[some]
        if ranking in self.found:
            scores = np.concatenate((self.found[ranking][0], scores))
            ids = np.concatenate((self.found[ranking][1], ids))
        order = np.lexsort((ids, -scores))[:self.n]
        self.found[ranking] = scores[order], ids[order]
        if len(order) == self.n:
            self.least[ranking] = scores[order[-1]]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rankings, scores and ids of all that is kept."""
        sizes = [len(ids) for _, ids in self.found.values()]
        return (np.repeat(np.array(list(self.found), dtype=np.int64), sizes),
                np.concatenate([s for s, _ in self.found.values()] or [np.empty(0, np.int64)]),
                np.concatenate([i for _, i in self.found.values()] or [np.empty(0, np.int64)]))


def mine_hard_negatives(vectors: DataFrame, is_anchor: Column, id_: str = "vec_id", label: str = "label",
                        vector: str = "embedding", scale: int = 256, n_positives: int = 5,
                        n_negatives: int = 5, least_percent: int = 80) -> DataFrame:
    """Rows of other labels that score nearly as high for an anchor as its best rows of its own label.

    Components become floor(scale * component); a score is the exact integer inner product with the
    anchor.  Anchors are the rows where ``is_anchor`` holds; the positives of an anchor are its
    first ``n_positives`` other rows of equal label, by falling score and then rising id.  For each
    positive the first ``n_negatives`` rows of other labels with a score between ``least_percent``
    per cent of the positive's and the positive's are returned: ``anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score`` and ``positive_rank``.

    No part take rows with a NULL id, label or vector, with a component that is NULL or not finite, or
    with components so large that a score might not fit a long (their length times the largest
    square reaches 2**62).  Rows meet only rows of equal length.  A row with the anchor's id is the
    anchor itself; other repeated rows rank one by one, and each anchor row is mined on its own.
    An anchor without positives, or a positive without negatives, gives no row.  Other columns
    are ignored, whatever their names.

    All candidates are compared with all anchors.  Blocks of both are bounded by bytes; each tile of
    the grid is a shuffle key of its own, so no label or copy group makes a hot one.  A candidate
    is shipped once for every ``ANCHOR_BYTES`` of anchors; nothing is broadcast or collected.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(f"`{id_}`").cast("long").alias("id"), F.col(f"`{label}`").cast("string").alias("label"),
        F.col(f"`{vector}`").cast("array<double>").alias("vector"), is_anchor.alias("anchor"),
    ).where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    blocks = write_blobs(_blocks(rows.drop("anchor"), scale), "candidates", compression="uncompressed")
    anchors = write_aside(
        _points(rows.where("anchor").drop("anchor"), scale)
        .withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    positives = _first(
        _tiles(blocks, anchors.withColumn("positives", F.lit(None).cast("array<long>")),
               lambda block: Positives(block, n_positives, 1)),
        ["anchor"], n_positives)
    lists = positives.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("list"))
    with_positives = write_aside(
        anchors.join(lists, "anchor").withColumn("positives", F.col("list.score")), "positives")
    negatives = _first(
        _tiles(blocks, with_positives, lambda block: Negatives(block, n_negatives, least_percent)),
        ["anchor", "place"], n_negatives)
    place = F.element_at("list", F.col("place") + 1)
    out = negatives.select("anchor", "place", "rank", F.col("id").alias("negative_id"),
                           F.col("score").alias("negative_score")).join(
        with_positives.select("anchor", F.col("id").alias("anchor_id"), "list"), "anchor")
    release(spark)
    return out.select("anchor_id", place["id"].alias("positive_id"), "rank", "negative_id",
                      place["score"].alias("positive_score"), "negative_score",
                      place["rank"].alias("positive_rank"))


def _points(rows: DataFrame, scale: int) -> DataFrame:
    """Rows with integer components, those that take part."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, values in integers(batch["vector"], scale):
                raw = [row.tobytes() for row in values.astype("<i8")]
                yield pa.RecordBatch.from_pydict({
                    "id": batch["id"].take(at), "label": batch["label"].take(at),
                    "length": pa.array(np.full(len(at), values.shape[1], dtype=np.int32)),
                    "components": pa.array(raw, pa.binary())})

    return rows.mapInArrow(run, POINT)


def _blocks(rows: DataFrame, scale: int) -> DataFrame:
    """Rows that take part, in blocks of one length."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}
        held: dict[int, int] = {}
        for batch in batches:
            for at, values in integers(batch["vector"], scale):
                length = values.shape[1]
                most = max(1, BLOCK_BYTES // (8 * max(1, length)))
                for begin in range(0, len(at), most):
                    part = slice(begin, begin + most)
                    if held.get(length, 0) + len(at[part]) > most:
                        yield _block(waiting.pop(length))
                        held[length] = 0
                    waiting.setdefault(length, []).append(
                        (batch["id"].take(at[part]), batch["label"].take(at[part]), values[part]))
                    held[length] = held.get(length, 0) + len(at[part])
        for parts in waiting.values():
            yield _block(parts)

    return rows.mapInArrow(run, "n long, data binary")


def _block(parts: list[tuple[pa.Array, pa.Array, np.ndarray]]) -> pa.RecordBatch:
    values = np.concatenate([v for _, _, v in parts])
    fitting = np.min_scalar_type(-int(np.abs(values).max(initial=0)) - 1)
    data = packed(pa.RecordBatch.from_pydict({
        "id": pa.concat_arrays([i for i, _, _ in parts]), "label": pa.concat_arrays([x for _, x, _ in parts]),
        "values": pa.FixedSizeListArray.from_arrays(pa.array(values.astype(fitting).ravel()), values.shape[1])
        if values.shape[1] else pa.array([[]] * len(values), pa.list_(pa.int64(), 0))}))
    return pa.RecordBatch.from_pydict({"n": [len(values)], "data": pa.array([data], pa.binary())})


def _anchor_block(table: pa.Table) -> pa.Table:
    table = table.combine_chunks()
    data = packed(table.drop_columns(["a_group"]).to_batches()[0])
    return pa.table({"a_group": table["a_group"][:1], "anchors": pa.array([data], pa.binary())})


def _tiles(blocks: DataFrame, anchors: DataFrame, compare: "Callable[[pa.RecordBatch], Compare]") -> DataFrame:
    """What ``compare`` keeps of all tiles: (anchor, place, score, id)."""
    spark = blocks.sparkSession
    n_blocks, n_rows = blocks.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    n_bytes = anchors.agg(F.coalesce(F.sum(F.length("components")), F.lit(0))).first()[0]
    even = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_groups = max(1, min(n_blocks, even + n_rows // GROUP_ROWS))
    n_anchor_groups = 1 + n_bytes // ANCHOR_BYTES
    anchor_blocks = (
        anchors.select("anchor", "id", "label", "length", "components", "positives",
                       F.pmod(F.xxhash64("anchor"), F.lit(n_anchor_groups)).alias("a_group"))
        .groupBy("a_group").applyInArrow(_anchor_block, "a_group long, anchors binary"))
    one = blocks.select(
        F.pmod(F.xxhash64("data"), F.lit(n_groups)).alias("c_group"), "data",
        _each(n_anchor_groups).alias("a_group"))
    other = anchor_blocks.select(
        "*", _each(n_groups).alias("c_group"))
    # shuffled for sure: the planner would take the exploded side to be as small as it was before
    tiles = one.join(other.hint("merge"), ["a_group", "c_group"]).sortWithinPartitions("a_group")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, work = None, None
        for batch in batches:
            for group, data, raw in zip(*(batch[c] for c in ("a_group", "data", "anchors")), strict=True):
                if group != current:
                    if work:
                        yield work.rows()
                    current, work = group, compare(unpacked(raw.as_buffer()))
                work.meet(unpacked(data.as_buffer()))
        if work:
            yield work.rows()

    return tiles.select("a_group", "data", "anchors").mapInArrow(run, "anchor long, place int, score long, id long")


def _each(n: int) -> Column:
    """A row for each number below ``n``."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


class Compare:
    """A block of anchors, and the best that the candidates met so far have for them."""

    def __init__(self, anchors: pa.RecordBatch, n: int, places: int) -> None:
        self.number, self.id = anchors["anchor"].to_numpy(), anchors["id"].to_numpy()
        self.label, self.length = anchors["label"].to_pylist(), anchors["length"].to_numpy()
        self.values = [np.frombuffer(v.as_buffer(), dtype="<i8").tolist() for v in anchors["components"]]
        self.largest = max((sum(map(abs, v)) for v in self.values), default=0)
        self.places = places
        self.best = Best(len(self.number) * places, n)

    def meet(self, block: pa.RecordBatch) -> None:
        """Compare a block of candidates, by label."""
        order = block["label"].cast(pa.string()).to_numpy(zero_copy_only=False).argsort(kind="stable")
        labels = block["label"].take(pa.array(order)).to_pylist()
        ids = block["id"].to_numpy()[order]
        length = block["values"].type.list_size
        values = block["values"].flatten().to_numpy().reshape(len(ids), length)[order].astype(np.int64)
        cuts = [i for i in range(len(labels)) if not i or labels[i] != labels[i - 1]]
        of_label = {labels[a]: slice(a, b) for a, b in zip(cuts, [*cuts[1:], len(labels)], strict=True)}
        self.compare(np.flatnonzero(self.length == length).tolist(), of_label, ids, values)

    def compare(self, anchors: list[int], of_label: dict[str, slice], ids: np.ndarray, values: np.ndarray) -> None:
        raise NotImplementedError

    def rows(self) -> pa.RecordBatch:
        ranking, scores, ids = self.best.rows()
        return pa.RecordBatch.from_pydict({
            "anchor": self.number[ranking // self.places],
            "place": (ranking % self.places).astype(np.int32), "score": scores, "id": ids})


class Positives(Compare):
    """Candidates of the anchor's label."""

    def compare(self, anchors: list[int], of_label: dict[str, slice], ids: np.ndarray, values: np.ndarray) -> None:
        blocks: dict[str, PackedBlock] = {}
        for i in anchors:
            label = self.label[i]
            if label not in of_label:
                continue
            own = of_label[label]
            if label not in blocks:
                blocks[label] = PackedBlock(values[own], self.largest)
            other = ids[own] != self.id[i]
            self.best.add(i, blocks[label].scores(self.values[i])[other], ids[own][other])


class Negatives(Compare):
    """Candidates of other labels within the range of a positive's score."""

    def __init__(self, anchors: pa.RecordBatch, n: int, least_percent: int) -> None:
        self.scores = [row.as_py() for row in anchors["positives"]]
        super().__init__(anchors, n, max(map(len, self.scores), default=1))
        self.ranges = [[(-(-least_percent * p // 100), p) for p in row] for row in self.scores]

    def compare(self, anchors: list[int], of_label: dict[str, slice], ids: np.ndarray, values: np.ndarray) -> None:
        block = PackedBlock(values, self.largest)
        for i in anchors:
            low, high = min(a for a, _ in self.ranges[i]), max(b for _, b in self.ranges[i])
            scores = block.scores(self.values[i])
            near = (scores >= low) & (scores <= high)
            near[of_label.get(self.label[i], slice(0))] = False
            at = np.flatnonzero(near)
            at = at[ids[at] != self.id[i]]
            if not len(at):
                continue
            some, own = scores[at], ids[at]
            for place, (low, high) in enumerate(self.ranges[i]):
                fits = (some >= low) & (some <= high)
                self.best.add(i * self.places + place, some[fits], own[fits])


def _first(found: DataFrame, ranking: list[str], n: int) -> DataFrame:
    """The first ``n`` rows of each ranking over all tasks."""
    order = Window.partitionBy(*ranking).orderBy(F.desc("score"), F.asc("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
