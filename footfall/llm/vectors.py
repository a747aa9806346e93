"""Embedding near-dedup: navigable small-world graphs per shard, audited and verified."""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from footfall.llm.exchange import write_blobs
from footfall.llm.graph import components
from footfall.scratch import write_aside

COSINE = 0.98
#: Distinct vectors of a shard, at most about; a task holds two shards and a bit for each pair.
SHARD = 8192
DEGREE, WIDE = 12, 24
BUILD_BEAM, FIRST_BEAM = 32, 32
#: Rows that walk the graph together, and vectors each of them expands in one step.
TOGETHER, EXPAND = 256, 4
AUDITED, RECALL = 128, 0.999
WIDEST = 128
#: How far a cosine in single precision may lie below the true one.
SLACK = 1e-5


@dataclass
class Graph:
    """``near[l]`` has a row of neighbours (-1: none) for each vector, on level ``l``.

    Every vector is on level 0, one in ``DEGREE`` of a level on the next; walks begin at
    ``entry`` on the top level.  Walks compare ``light``, the vectors in single precision.
    ``lost`` are vectors that a walk towards themselves does not reach; queries are compared with
    them one by one.
    """

    vectors: np.ndarray
    near: list[np.ndarray]
    entry: int
    lost: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=np.int64))

    def __post_init__(self) -> None:
        self.light = self.vectors.astype(np.float32)


def unit_rows(values: np.ndarray) -> np.ndarray:
    """Rows of length 1; dividing by the largest component first avoids overflow."""
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values ** 2).sum(axis=1, keepdims=True))


def _cosines(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray) -> np.ndarray:
    return np.matmul(vectors[ids], queries[:, :, None])[:, :, 0]


def _descend(graph: Graph, queries: np.ndarray, level: int) -> np.ndarray:
    """The vector at which a greedy walk over the levels above ``level`` ends."""
    at = np.full(len(queries), graph.entry)
    best = queries @ graph.light[graph.entry]
    for upper in range(len(graph.near) - 1, level, -1):
        moving = np.arange(len(queries))
        while len(moving):
            ids = graph.near[upper][at[moving]]
            cosine = np.where(ids >= 0, _cosines(graph.light, ids, queries[moving]), -2)
            pick = np.argmax(cosine, axis=1)
            value = cosine[np.arange(len(moving)), pick]
            better = value > best[moving]
            moving, pick = moving[better], ids[better, pick[better]]
            at[moving], best[moving] = pick, value[better]
    return at


def beam_search(graph: Graph, queries: np.ndarray, beam: int, level: int = 0
                ) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nearest vectors that a walk on ``level`` finds for each query: numbers (-1:
    none) and cosines.  All queries step together, each expanding its best few vectors."""
    queries = queries.astype(np.float32)
    n, rows = len(queries), np.arange(len(queries))
    entry = _descend(graph, queries, level)
    ids = np.full((n, beam), -1)
    cosine = np.full((n, beam), -2, dtype=np.float32)
    open_ = np.zeros((n, beam), dtype=bool)
    seen = np.zeros((n, len(graph.vectors)), dtype=bool)
    ids[:, 0], open_[:, 0] = entry, True
    cosine[:, 0] = np.einsum("qd,qd->q", graph.light[entry], queries)
    seen[rows, entry] = True
    active = rows
    width = min(EXPAND, beam)
    while len(active):
        waiting = np.where(open_[active], cosine[active], -3)
        pick = np.argpartition(-waiting, width - 1, axis=1)[:, :width]
        chosen = np.take_along_axis(waiting, pick, axis=1) > -2
        current = np.where(chosen, np.take_along_axis(ids[active], pick, axis=1), -1)
        np.put_along_axis(waiting, pick, -3, axis=1)
        open_[active] = waiting > -2
        found = np.where(current[:, :, None] >= 0, graph.near[level][current], -1)
        found = found.reshape(len(active), -1)
        found = np.where((found >= 0) & ~seen[active[:, None], found], found, -1)
        found = np.sort(found, axis=1)
        found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
        seen[np.repeat(active, (found >= 0).sum(axis=1)), found[found >= 0]] = True
        value = np.where(found >= 0, _cosines(graph.light, found, queries[active]), -2)
        all_ids = np.concatenate((ids[active], found), axis=1)
        all_cosine = np.concatenate((cosine[active], value), axis=1)
        all_open = np.concatenate((open_[active], found >= 0), axis=1)
        top = np.argpartition(-all_cosine, beam - 1, axis=1)[:, :beam]
        ids[active] = np.take_along_axis(all_ids, top, axis=1)
        cosine[active] = np.take_along_axis(all_cosine, top, axis=1)
        open_[active] = np.take_along_axis(all_open, top, axis=1)
        active = active[open_[active].any(axis=1)]
    return ids, cosine


def _select(vectors: np.ndarray, own: np.ndarray, ids: np.ndarray, cosine: np.ndarray,
            most: int) -> np.ndarray:
    """Up to ``most`` neighbours of each row: the nearest that no chosen one is nearer to, so that
    links lead in all directions out of a tight group; free places go to the nearest others."""
    order = np.argsort(-cosine, axis=1, kind="stable")
    ids, cosine = np.take_along_axis(ids, order, axis=1), np.take_along_axis(cosine, order, axis=1)
    usable = (ids >= 0) & (ids != own[:, None])
    around = vectors[ids]
    between = np.matmul(around, around.transpose(0, 2, 1))
    diverse = usable.copy()
    for i in range(ids.shape[1]):
        hidden = (between[:, i, :] > cosine) & diverse[:, i, None]
        hidden[:, :i + 1] = False
        diverse &= ~hidden
    rank = np.where(diverse, 0, np.where(usable, 1, 2)) * ids.shape[1] + np.arange(ids.shape[1])
    top = np.argsort(rank, axis=1, kind="stable")[:, :most]
    out = np.where(np.take_along_axis(usable, top, axis=1), np.take_along_axis(ids, top, axis=1), -1)
    if out.shape[1] < most:
        out = np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)
    return out


def _link(graph: Graph, level: int, new: np.ndarray, ids: np.ndarray, cosine: np.ndarray) -> None:
    """Give new vectors their neighbours, and these their links back."""
    near = graph.near[level]
    most = near.shape[1]
    out = _select(graph.light, new, ids, cosine, DEGREE)
    near[new, :DEGREE] = out
    source = np.repeat(new, DEGREE)[out.ravel() >= 0]
    target = out.ravel()[out.ravel() >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    nodes, begin, count = np.unique(target, return_index=True, return_counts=True)
    for size in np.unique(count):
        at = np.flatnonzero(count == size)
        for few in np.array_split(at, -(-len(at) * (most + size) ** 2 // (1 << 21)) or 1):
            if not len(few):
                continue
            back = source[begin[few][:, None] + np.arange(size)]
            both = np.sort(np.concatenate((near[nodes[few]], back), axis=1), axis=1)
            both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
            value = np.where(both >= 0, _cosines(graph.light, both, graph.light[nodes[few]]), -2)
            near[nodes[few]] = _select(graph.light, nodes[few], both, value, most)


def build(vectors: np.ndarray) -> Graph:
    """Insert unit vectors in growing groups; those of a group also see each other."""
    n = len(vectors)
    level = np.zeros(n, dtype=int)
    draw = np.random.default_rng(n)
    while (level == level.max()).sum() > WIDE:
        up = np.flatnonzero(level == level.max())
        level[up[draw.random(len(up)) < 1 / DEGREE]] += 1
        if (level == level.max()).sum() == len(up):
            break
    entry = int(np.argmax(level))
    graph = Graph(vectors, [np.full((n, WIDE), -1) for _ in range(level.max() + 1)], entry)
    order = np.concatenate(([entry], np.flatnonzero(np.arange(n) != entry)))
    done = 1
    while done < n:
        new = order[done:done + min(done, TOGETHER)]
        for at in range(level.max() + 1):
            here = new[level[new] >= at]
            if len(here):
                ids, cosine = beam_search(graph, vectors[here], BUILD_BEAM, at)
                mutual = graph.light[here] @ graph.light[here].T
                np.fill_diagonal(mutual, -2)
                k = min(BUILD_BEAM, len(here))
                top = np.argpartition(-mutual, k - 1, axis=1)[:, :k]
                _link(graph, at, here, np.concatenate((ids, here[top]), axis=1),
                      np.concatenate((cosine, np.take_along_axis(mutual, top, axis=1)), axis=1))
        done += len(new)
    reached = np.zeros(n, dtype=bool)
    for at in range(0, n, TOGETHER):
        ids, _ = beam_search(graph, vectors[at:at + TOGETHER], FIRST_BEAM)
        own = np.arange(at, at + len(ids))[:, None]
        reached[at:at + len(ids)] = (ids == own).any(axis=1)
    graph.lost = np.flatnonzero(~reached)
    return graph


def linked(graph: Graph, queries: np.ndarray, least: float) -> np.ndarray:
    """For each query a row of flags: the vectors found with a cosine of ``least`` or more.

    The beam begins narrow.  An audit compares some queries with all vectors; as long as those
    whose beam has room left find too few of their true links, the beam is widened for all.  A
    query whose whole beam is within reach may have more: its own beam is widened, and beyond
    ``WIDEST``, or a quarter of the shard, it is compared with all vectors.
    """
    n = len(graph.vectors)
    out = np.zeros((len(queries), n), dtype=bool)
    audited = np.unique(np.linspace(0, len(queries) - 1, min(AUDITED, len(queries))).astype(int))
    truth = queries[audited] @ graph.vectors.T >= least
    beam, widest = FIRST_BEAM, min(n / 4, WIDEST)
    while beam < n / 4:
        found, full = _walk(graph, queries[audited], beam, least)
        if _recall(found[~full], truth[~full]) >= RECALL:
            break
        beam *= 2
    todo = np.arange(len(queries))
    widest = max(widest, beam + 1) if beam < n / 4 else 0
    while len(todo) and beam < widest:
        flags, full = _walk(graph, queries[todo], beam, least)
        out[todo] = flags
        todo, beam = todo[full], beam * 2
    for at in range(0, len(todo), TOGETHER):
        rows = todo[at:at + TOGETHER]
        out[rows] = queries[rows] @ graph.vectors.T >= least
    for at in range(0, len(graph.lost), TOGETHER):
        some = graph.lost[at:at + TOGETHER]
        out[:, some] = queries @ graph.vectors[some].T >= least
    return out


def _walk(graph: Graph, queries: np.ndarray, beam: int, least: float
          ) -> tuple[np.ndarray, np.ndarray]:
    flags = np.zeros((len(queries), len(graph.vectors)), dtype=bool)
    full = np.zeros(len(queries), dtype=bool)
    for at in range(0, len(queries), TOGETHER):
        ids, cosine = beam_search(graph, queries[at:at + TOGETHER], beam)
        hit = cosine >= least - SLACK
        row, column = np.nonzero(hit)
        column = ids[row, column]
        true = np.einsum("nd,nd->n", queries[at + row], graph.vectors[column]) >= least
        flags[at + row[true], column[true]] = True
        full[at:at + len(ids)] = hit.all(axis=1)
    return flags, full


def _recall(found: np.ndarray, truth: np.ndarray) -> float:
    return (found & truth).sum() / max(truth.sum(), 1)


def _smallest(flags: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spread the smallest number over the links until nothing changes."""
    rows, columns = flags.any(axis=1), flags.any(axis=0)
    part, a, b = flags[np.ix_(rows, columns)], left[rows].copy(), right[columns].copy()
    top = np.iinfo(np.int64).max
    changed = True
    while changed and part.size:
        was = a.copy(), b.copy()
        for at in range(0, len(a), 1024):
            block = part[at:at + 1024]
            a[at:at + 1024] = np.minimum(a[at:at + 1024], np.where(block, b, top).min(axis=1))
            b = np.minimum(b, np.where(block, a[at:at + 1024, None], top).min(axis=0))
        changed = (was[0] != a).any() or (was[1] != b).any()
    left, right = left.copy(), right.copy()
    left[rows], right[columns] = a, b
    return left, right


INDEX = StructType([StructField("ids", BinaryType()), StructField("copies", BinaryType()),
                    StructField("vectors", BinaryType()), StructField("graph", BinaryType()),
                    StructField("levels", LongType()), StructField("entry", LongType()),
                    StructField("lost", BinaryType())])
GROUP = ["_label", "_dim", "_shard"]


def _is_usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def vector_duplicates(rows: DataFrame, key: str = "vec_id", vector: str = "embedding",
                      label: str = "label", least: float = COSINE, shard: int = SHARD) -> DataFrame:
    """Link vectors of the same label whose cosine, in double precision, is ``least`` or more;
    one row per row of ``rows``.

    ``n_links`` counts the other vectors linked directly, ``component_id`` is the smallest key
    reachable by links, and ``kept`` tells whether that is the row's own.  Rows whose vector is
    NULL, zero or holds a component that is NULL or not finite, and rows without a label or key,
    link with nothing.  Vectors of different lengths do not link.  Repeated rows are vectors of
    their own.

    Equal vectors of a label become one class.  The classes of a label are dealt by hash into
    shards of at most about ``shard`` vectors, and each shard gets a hierarchical navigable
    small-world graph.  Every shard is searched with the vectors of every shard of its label
    (pairs of shards once).  Beams widen until an audit against all vectors of the shard passes;
    every reported link has had its cosine computed.  A search returns one row for each vector:
    its number of links and the smallest vector its links lead to; so a group of any size costs
    rows in proportion to its size.  Components are then joined across shards.
    """
    fields = [F.col(key).cast("long").alias("_key"), F.col(label).alias("_label"),
              F.col(vector).cast("array<double>").alias("_vector")]
    base = rows.select(*fields).withColumn("_ok", F.coalesce(
        _is_usable(F.col("_vector")) & F.col("_label").isNotNull() & F.col("_key").isNotNull(),
        F.lit(False)))
    name = [F.xxhash64("_vector").alias("_h1"), F.xxhash64(F.lit(1), "_vector").alias("_h2")]
    named = base.where("_ok").select("*", F.size("_vector").alias("_dim"), *name)
    classes = write_aside(
        named.groupBy("_label", "_dim", "_h1", "_h2")
        .agg(F.min("_key").alias("id"), F.count(F.lit(1)).alias("n"),
             F.first("_vector").alias("vector")), "classes")
    shards = write_aside(classes.groupBy("_label", "_dim").agg(
        F.ceil(F.count(F.lit(1)) / shard).cast("int").alias("_shards")), "shards")
    dealt = classes.join(shards, ["_label", "_dim"]).withColumn(
        "_shard", F.pmod(F.xxhash64("_h2", "_h1"), F.col("_shards")).cast("int"))
    group = dealt.select(*GROUP).schema
    columns = StructType([*group.fields, *INDEX.fields])
    arrow = to_arrow_schema(columns)

    def index(table: pa.Table) -> pa.Table:
        flat = table["vector"].combine_chunks()
        vectors = unit_rows(np.asarray(flat.flatten()).reshape(table.num_rows, -1))
        graph = build(vectors)
        one = {name: [table[name][0].as_py()] for name in GROUP}
        return pa.Table.from_pydict(one | {
            "ids": [table["id"].to_numpy().astype("<i8").tobytes()],
            "copies": [table["n"].to_numpy().astype("<i8").tobytes()],
            "vectors": [graph.vectors.astype("<f8").tobytes()],
            "graph": [np.concatenate(graph.near).astype("<i4").tobytes()],
            "levels": [len(graph.near)], "entry": [graph.entry],
            "lost": [graph.lost.astype("<i8").tobytes()],
        }, schema=arrow)

    indexes = write_blobs(dealt.groupBy(*GROUP).applyInArrow(index, columns), "indexes")
    query = indexes.select("_label", "_dim", F.col("_shard").alias("_other"),
                           F.col("ids").alias("ids_b"), F.col("copies").alias("copies_b"),
                           F.col("vectors").alias("vectors_b"))
    pairs = indexes.join(query, ["_label", "_dim"]).where("_other >= _shard")

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                a, b = (np.frombuffer(row[c], "<i8") for c in ("ids", "ids_b"))
                n_a, n_b = (np.frombuffer(row[c], "<i8") for c in ("copies", "copies_b"))
                vectors = np.frombuffer(row["vectors"], "<f8").reshape(len(a), -1)
                near = np.frombuffer(row["graph"], "<i4").reshape(row["levels"], len(a), WIDE)
                graph = Graph(vectors, list(near), row["entry"], np.frombuffer(row["lost"], "<i8"))
                flags = linked(graph, np.frombuffer(row["vectors_b"], "<f8").reshape(len(b), -1),
                               least)
                same = row["_shard"] == row["_other"]
                if same:
                    flags |= flags.T
                    np.fill_diagonal(flags, False)
                low_b, low_a = _smallest(flags, b, a)
                links_b = flags @ n_a
                parts = [(b, links_b, low_b)]
                if not same:
                    parts.append((a, flags.T @ n_b, low_a))
                for ids, links, low in parts:
                    some = links > 0
                    yield pa.RecordBatch.from_pydict(
                        {"id": ids[some], "links": links[some], "low": low[some]})

    found = write_aside(pairs.mapInArrow(search, "id long, links long, low long"), "links")
    totals = found.groupBy("id").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("id").alias("a"), F.col("low").alias("b")))
    result = write_aside(
        classes.select("_label", "_dim", "_h1", "_h2", "id", "n")
        .join(totals, "id", "left").join(joined, F.col("id") == F.col("node"), "left")
        .select("_label", "_dim", "_h1", "_h2",
                (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("component", "id").alias("component_id")), "classes")
    full = named.select("_key", "_label", "_dim", "_h1", "_h2").join(
        result, ["_label", "_dim", "_h1", "_h2"]).select("_key", "n_links", "component_id")
    alone = base.where(~F.col("_ok")).select(
        "_key", F.lit(0).cast("long").alias("n_links"), F.col("_key").alias("component_id"))
    return full.unionByName(alone).select(
        F.col("_key").alias(key), "n_links", "component_id",
        F.coalesce(F.col("_key") == F.col("component_id"), F.lit(True)).alias("kept"))
