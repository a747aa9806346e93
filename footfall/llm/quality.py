"""Quality classifier: co-training of a view of the text and a view of the metadata."""

from collections.abc import Callable, Generator, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from footfall.llm.exchange import hidden, others, release, shown, slices, texts_of
from footfall.llm.words import words_of
from footfall.scratch import write_aside

#: Bound of the labelled rows that the classifiers are fitted to; all unlabelled rows take part.
LABELLED_ROWS = 8000
TEXT_BITS, META_BITS = 14, 12
ROUNDS = 4
#: In each round a view labels this part of the unlabelled rows, the ones it is surest of, and
#: only with this probability at least.
SHARE, SURE = 0.1, 0.9
FOLDS = 5
STEPS, RATE, SPARSITY = 200, 0.5, 1e-4
#: A round goes on from the weights before it, by at most so many passes over the named rows or
#: until the loss falls by less than this part; steps remember so many earlier ones.
PASSES, TOLERANCE, MEMORY = 12, 1e-4, 8
#: Scores of unlabelled rows are counted in steps of 0.01 from -30 to 30.
BINS, FARTHEST = 6000, 30.0

Sparse = tuple[np.ndarray, np.ndarray, np.ndarray]


def text_features(texts: list[bytes | None]) -> Sparse:
    """Hashed words and shares of kinds of characters: (first of each row, places, values).

    A row's values have length 1 before the shares are added, whatever the length of the text.
    """
    words = words_of(texts, lower=True)
    key = words.text_of().astype(np.int64) << TEXT_BITS
    key += (words.hashes >> np.uint64(64 - TEXT_BITS)).astype(np.int64)
    place, count = np.unique(key, return_counts=True)
    row = place >> TEXT_BITS
    value = np.log1p(count)
    norm = np.sqrt(np.bincount(row, weights=value ** 2, minlength=len(texts)))
    value = 4 * value / norm[row]
    shares = np.array([_shares(text or b"", n) for text, n in zip(texts, words.counts, strict=True)])
    shares = shares.reshape(len(texts), -1)
    dense = np.tile(np.arange(shares.shape[1]) + (1 << TEXT_BITS), len(texts))
    rows = np.concatenate((row, np.repeat(np.arange(len(texts)), shares.shape[1])))
    order = np.argsort(rows, kind="stable")
    places = np.concatenate((place & ((1 << TEXT_BITS) - 1), dense))[order]
    values = np.concatenate((value, shares.ravel()))[order].astype(np.float32)
    return np.searchsorted(rows[order], np.arange(len(texts) + 1)), places, values


N_SHARES = 6


def _shares(text: bytes, n_words: int) -> list[float]:
    raw = np.frombuffer(text, dtype=np.uint8)
    n = max(len(raw), 1)
    upper = ((raw >= 0x41) & (raw <= 0x5A)).sum()
    digit = ((raw >= 0x30) & (raw <= 0x39)).sum()
    blank = ((raw == 0x20) | ((raw >= 9) & (raw <= 13))).sum()
    sign = ((raw > 0x20) & (raw < 0x7F)).sum() - upper - digit - ((raw >= 0x61) & (raw <= 0x7A)).sum()
    return [1.0, 3 * upper / n, 3 * digit / n, 3 * blank / n, 3 * sign / n,
            np.log1p(n_words) / 5]


def meta_features(columns: list[list]) -> Sparse:
    """One hashed place per column; a number stands for its order of magnitude (base 2)."""
    n = len(columns[0]) if columns else 0
    places = np.zeros((n, len(columns) + 1), dtype=np.int64)
    for j, values in enumerate(columns):
        names = [f"{j}:{np.log2(max(v, 0) + 1):.0f}" if isinstance(v, (int, float)) else f"{j}:{v}"
                 for v in values]
        hashed = words_of([name.replace(" ", "_").encode() for name in names]).hashes
        places[:, j + 1] = 1 + (hashed >> np.uint64(64 - META_BITS)).astype(np.int64)
    flat = places.ravel()
    return np.arange(n + 1) * (len(columns) + 1), flat, np.ones(len(flat), dtype=np.float32)


def logits(features: Sparse, weights: np.ndarray) -> np.ndarray:
    first, places, values = features
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return np.bincount(row, weights=weights[places] * values, minlength=len(first) - 1)


def _rows(features: Sparse, chosen: np.ndarray) -> Sparse:
    first, places, values = features
    size = first[chosen + 1] - first[chosen]
    begin = np.concatenate(([0], np.cumsum(size)))
    at = np.repeat(first[chosen] - begin[:-1], size) + np.arange(begin[-1])
    return begin, places[at], values[at]


def fit(features: Sparse, y: np.ndarray, width: int) -> np.ndarray:
    """Logistic regression by proximal AdaGrad: both classes weigh the same, and an L1 penalty
    leaves the many words that say nothing at weight 0."""
    first, places, values = features
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    good = max(float(y.mean()), 1e-6)
    importance = np.where(y > 0.5, 0.5 / good, 0.5 / max(1 - good, 1e-6)) / len(y)
    weights, seen = np.zeros(width), np.full(width, 1e-8)
    for _ in range(STEPS):
        error = (1 / (1 + np.exp(-np.clip(logits(features, weights), -30, 30))) - y) * importance
        slope = np.bincount(places, weights=values * error[row], minlength=width)
        seen += slope ** 2
        step = RATE / np.sqrt(seen)
        weights -= step * slope
        weights = np.sign(weights) * np.maximum(np.abs(weights) - step * SPARSITY, 0)
    return weights


def _platt(scores: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Weights of each score and a constant, fitted by Newton steps on rows not trained on."""
    x = np.column_stack([*scores, np.ones(len(y))])
    weights = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(x.shape[1])
        weights -= np.linalg.solve(hessian, x.T @ (p - y) + 1e-3 * weights)
    return weights


@dataclass
class Views:
    """Weights of both views, each one's calibration (slope, constant), and of both together."""

    text: np.ndarray
    meta: np.ndarray
    text_scale: np.ndarray
    meta_scale: np.ndarray
    both: np.ndarray


WIDTHS = ((1 << TEXT_BITS) + N_SHARES, (1 << META_BITS) + 1)


def _importance(n_bad: float, n_good: float) -> np.ndarray:
    """Weights of a bad and of a good row, with which both classes weigh the same."""
    n = max(n_bad + n_good, 1)
    return 0.5 / np.maximum(np.array([n_bad, n_good]) / n, 1e-6) / n


def loss_and_slope(features: Sparse, y: np.ndarray, importance: np.ndarray,
                   weights: np.ndarray) -> np.ndarray:
    """Sum of the rows' logistic losses, then of their slopes."""
    first, places, values = features
    score, weight = logits(features, weights), importance[(y > 0.5).astype(int)]
    loss = np.logaddexp(0, np.where(y > 0.5, -score, score)) @ weight
    error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - y) * weight
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    slope = np.bincount(places, weights=values * error[row], minlength=len(weights))
    return np.concatenate(([loss], slope))


def descend(weights: np.ndarray) -> Generator[np.ndarray, np.ndarray, np.ndarray]:
    """Orthant-wise L-BFGS with the L1 penalty: yields points, takes loss and slope at them."""

    def steepest(at: np.ndarray, slope: np.ndarray) -> np.ndarray:
        flat = np.sign(slope) * np.maximum(np.abs(slope) - SPARSITY, 0)
        return np.where(at == 0, flat, slope + SPARSITY * np.sign(at))

    told = yield weights
    value, slope = told[0] + SPARSITY * np.abs(weights).sum(), told[1:]
    past: list[tuple[np.ndarray, np.ndarray]] = []
    size = 1.0
    for _ in range(PASSES - 1):
        steep = steepest(weights, slope)
        if not steep.any():
            break
        direction = _newton(steep, past)
        direction[direction * steep >= 0] = 0
        if not past:
            direction /= np.linalg.norm(direction)
        new = weights + size * direction
        new[new * np.where(weights == 0, -np.sign(steep), np.sign(weights)) < 0] = 0
        told = yield new
        reached = told[0] + SPARSITY * np.abs(new).sum()
        if reached > value + 1e-4 * float(steep @ (new - weights)):
            size /= 4
            continue
        if (moved := new - weights) @ (turned := told[1:] - slope) > 1e-12:
            past = [*past, (moved, turned)][-MEMORY:]
        done = value - reached < TOLERANCE * value
        weights, value, slope, size = new, reached, told[1:], 1.0
        if done:
            break
    return weights


def _newton(steep: np.ndarray, past: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    direction, parts = -steep, []
    for moved, turned in reversed(past):
        parts.append(part := (moved @ direction) / (moved @ turned))
        direction = direction - part * turned
    if past:
        moved, turned = past[-1]
        direction = direction * (moved @ turned) / (turned @ turned)
    for (moved, turned), part in zip(past, reversed(parts), strict=True):
        direction = direction + (part - (turned @ direction) / (moved @ turned)) * moved
    return direction


#: Of a view in a round: bin and part of it up to which the lowest scores are named bad, and
#: bin and part from which the highest are named good.
Cut = tuple[int, float, int, float]
Round = tuple[list[np.ndarray], list[Cut]]


def _bin(score: np.ndarray) -> np.ndarray:
    score = np.clip(score, -FARTHEST, FARTHEST)
    return ((score + FARTHEST) * ((BINS - 1) / (2 * FARTHEST))).astype(np.int64)


def cut_of(counts: np.ndarray, n_low: int, n_high: int) -> Cut:
    """Where the ``n_low`` lowest and the ``n_high`` highest of the counted scores end."""

    def end(ordered: np.ndarray, n: int) -> tuple[int, float]:
        sums = np.cumsum(ordered)
        at = int(np.searchsorted(sums, n))
        if at == len(sums):
            return at, 0.0
        return at, float((n - sums[at] + ordered[at]) / max(ordered[at], 1))

    low, low_part = end(counts, n_low)
    high, high_part = end(counts[::-1], n_high)
    return low, low_part, len(counts) - 1 - high, high_part


def _named(views: tuple[Sparse, Sparse], luck: np.ndarray, rounds: list[Round]) -> list[np.ndarray]:
    """For each view, the class that the other one named each row in these rounds; else -1.

    ``luck`` from 0 to 1 decides which rows of the last bin are in, where all are alike.
    """
    sure = np.log(SURE / (1 - SURE))
    known = [np.full(len(luck), -1), np.full(len(luck), -1)]
    for weights, cuts in rounds:
        new = []
        for v, (low, low_part, high, high_part) in enumerate(cuts):
            score = logits(views[v], weights[v])
            at, free = _bin(score), known[1 - v] < 0
            bad = (at < low) | ((at == low) & (luck < low_part))
            good = (at > high) | ((at == high) & (luck < high_part))
            new.append(np.where(free & good & (score >= sure), 1,
                                np.where(free & bad & (score <= -sure), 0, -1)))
        known = [np.where(given >= 0, given, had) for given, had in zip(new[::-1], known, strict=True)]
    return known


def _packed_views(rows: DataFrame, metadata: list[str]) -> DataFrame:
    """Of each row ``_key``, a number ``luck`` from 0 to 1, and places and values of both views."""
    fields = rows.select("_key", "luck").schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text="_text", limit=1 << 20):
                data = []
                for first, places, values in both_views(part, metadata):
                    ends = list(zip(first[:-1].tolist(), first[1:].tolist(), strict=True))
                    small, single = places.astype("<u2"), values.astype("<f4")
                    data += [pa.array([small[a:b].tobytes() for a, b in ends], pa.binary()),
                             pa.array([single[a:b].tobytes() for a, b in ends], pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [part["_key"], part["luck"], *data], ["_key", "luck", *PACKED])

    return rows.mapInArrow(run, f"{_ddl(fields)}, " + ", ".join(f"{c} binary" for c in PACKED))


PACKED = ["at0", "by0", "at1", "by1"]


def _unpacked(places: pa.Array, values: pa.Array) -> Sparse:
    size = np.asarray(pc.binary_length(places), dtype=np.int64) // 2
    return (np.concatenate(([0], np.cumsum(size))),
            np.frombuffer(b"".join(places.to_pylist()), dtype="<u2").astype(np.int64),
            np.frombuffer(b"".join(values.to_pylist()), dtype="<f4"))


def _summed(rows: DataFrame, of: Callable[[pa.RecordBatch], np.ndarray], size: int,
            data: str) -> np.ndarray:
    """The sum of a vector of ``size`` numbers over all rows, added up in tasks and over them."""
    tasks = rows.sparkSession.sparkContext.defaultParallelism

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for part in slices(batch, text=data, limit=1 << 20):
                total += of(part)
        yield pa.RecordBatch.from_pydict({"data": pa.array([total.tobytes()], pa.binary())})

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for one in batch["data"].to_pylist():
                total += np.frombuffer(one)
        yield pa.RecordBatch.from_pydict({"data": pa.array([total.tobytes()], pa.binary())})

    sums = rows.coalesce(tasks).mapInArrow(each, "data binary")
    sums = sums.repartition(int(tasks ** 0.5)).mapInArrow(add, "data binary")
    return sum((np.frombuffer(r.data) for r in sums.collect()), np.zeros(size))


def co_train(text: Sparse, meta: Sparse, y: np.ndarray, calibrate: np.ndarray,
             unlabelled: DataFrame) -> Views:
    """``y`` is 1 or 0; rows in ``calibrate`` are not trained on.  ``unlabelled`` has the packed
    views of all rows without a label.

    Both views are fitted to the labelled rows.  In each round each names the rows it is surest
    of among the unlabelled ones, as many of either class as its share, for the other, which goes
    on from its weights with the labelled rows and all that were named to it.  Tasks score, count
    and name the unlabelled rows, and sum up the losses and slopes of the named ones; the driver
    gets vectors of fixed size.
    """
    views = (text, meta)
    labelled = np.flatnonzero(~calibrate)
    own, target = [_rows(f, labelled) for f in views], y[labelled].astype(float)
    weights = [fit(f, target, w) if len(labelled) else np.zeros(w)
               for f, w in zip(own, WIDTHS, strict=True)]
    base = float(target.mean()) if len(labelled) else 0.5
    n = SHARE * unlabelled.count()
    rounds: list[Round] = []
    named, counts = None, np.array([[(target < 0.5).sum(), (target > 0.5).sum()]] * 2)
    for _ in range(ROUNDS if len(labelled) else 0):
        tally = _counted(unlabelled, weights, rounds)
        rounds.append((weights, [cut_of(c, int(n * (1 - base)), int(n * base)) for c in tally]))
        new = write_aside(_newly_named(unlabelled, rounds), "named")
        for row in new.groupBy("view", "y").agg(F.count(F.lit(1)).alias("n")).collect():
            counts[row["view"], row["y"]] += row["n"]
        named = new if named is None else named.unionByName(new)
        weights = _refitted(weights, own, target, named, counts)
    held = np.flatnonzero(calibrate)
    scores = [logits(_rows(f, held), w) for f, w in zip(views, weights, strict=True)]
    target = y[held].astype(float)
    return Views(weights[0], weights[1], _platt(scores[:1], target), _platt(scores[1:], target),
                 _platt(scores, target))


def _counted(unlabelled: DataFrame, weights: list[np.ndarray], rounds: list[Round]) -> np.ndarray:
    """For each view, how many rows that it did not name yet have a score in each bin."""
    shared = unlabelled.sparkSession.sparkContext.broadcast((weights, rounds))

    def of(part: pa.RecordBatch) -> np.ndarray:
        weights, rounds = shared.value
        views = _unpacked(part["at0"], part["by0"]), _unpacked(part["at1"], part["by1"])
        known = _named(views, np.asarray(part["luck"]), rounds)
        return np.concatenate([
            np.bincount(_bin(logits(f, w))[known[1 - v] < 0], minlength=BINS)
            for v, (f, w) in enumerate(zip(views, weights, strict=True))])

    return _summed(unlabelled, of, 2 * BINS, "by0").reshape(2, BINS)


def _newly_named(unlabelled: DataFrame, rounds: list[Round]) -> DataFrame:
    """The rows that the last round names: for which view, the class, and that view of them."""
    shared = unlabelled.sparkSession.sparkContext.broadcast(rounds)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text="by0", limit=1 << 20):
                views = _unpacked(part["at0"], part["by0"]), _unpacked(part["at1"], part["by1"])
                luck = np.asarray(part["luck"])
                before = _named(views, luck, shared.value[:-1])
                for v, now in enumerate(_named(views, luck, shared.value)):
                    new = np.flatnonzero((now >= 0) & (before[v] < 0))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(new), v), pa.int32()), pa.array(now[new], pa.int32()),
                         part[f"at{v}"].take(pa.array(new)), part[f"by{v}"].take(pa.array(new))],
                        ["view", "y", "at", "by"])

    return unlabelled.mapInArrow(run, "view int, y int, at binary, by binary")


def _refitted(weights: list[np.ndarray], own: list[Sparse], target: np.ndarray, named: DataFrame,
              counts: np.ndarray) -> list[np.ndarray]:
    """The weights of both views after a round; one pass serves a step of both."""
    context = named.sparkSession.sparkContext
    importance = [_importance(*c) for c in counts]
    ways = [descend(w) for w in weights]
    points: list[np.ndarray | None] = [next(way) for way in ways]
    found = list(weights)
    begins = np.cumsum([0] + [w + 1 for w in WIDTHS])
    while any(p is not None for p in points):
        shared = context.broadcast(points)

        def of(part: pa.RecordBatch) -> np.ndarray:
            sums = []
            for v, (point, width) in enumerate(zip(shared.value, WIDTHS, strict=True)):
                if point is None:
                    sums.append(np.zeros(width + 1))
                    continue
                mine = part.filter(pc.equal(part["view"], v))
                sums.append(loss_and_slope(_unpacked(mine["at"], mine["by"]),
                                           np.asarray(mine["y"]), importance[v], point))
            return np.concatenate(sums)

        total = _summed(named, of, int(begins[-1]), "by")
        shared.unpersist()
        for v, point in enumerate(points):
            if point is None:
                continue
            told = total[begins[v]:begins[v + 1]] + loss_and_slope(own[v], target, importance[v], point)
            try:
                points[v] = ways[v].send(told)
            except StopIteration as end:
                found[v], points[v] = end.value, None
    return found


RESULT = StructType([StructField(n, DoubleType()) for n in ("score", "text_score", "meta_score")])


def learn(docs: DataFrame, labels: DataFrame, metadata: list[str], text: str = "text",
          key: str = "doc_id", label: str = "good", labelled: int = LABELLED_ROWS) -> Views:
    """Fit both views to at most about ``labelled`` rows with a label and all rows without.

    Rows with a label are taken by a hash of the key, the same ones whenever asked.  A label given
    more than once counts if it is the same each time; a NULL key or label is none.
    """
    known = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.min(F.col(label).cast("int")).alias("_y"), F.max(F.col(label).cast("int")).alias("_z"))
        .where("_y = _z").drop("_z")
    )
    part = F.lit(float(1 << 30))
    place = F.pmod(F.xxhash64(F.col("_key"), F.lit(11)), F.lit(1 << 30)) / part
    n_known = known.count()
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), *metadata)
    few = known.where(place <= min(1.0, labelled / max(n_known, 1)))
    sample = rows.join(few, "_key").limit(2 * labelled)
    luck = F.pmod(F.xxhash64("_key", "_text", F.lit(13)), F.lit(1 << 30)) / part
    rows = rows.withColumn("luck", luck)
    keyed, unkeyed = (_packed_views(rows.where(which), metadata)
                      for which in (F.col("_key").isNotNull(), F.col("_key").isNull()))
    without = write_aside(
        keyed.join(known.hint("shuffle_hash"), "_key", "left_anti").unionByName(unkeyed).drop("_key"),
        "unlabelled")
    table = _features(sample.withColumn("_fold", F.crc32(F.col("_key").cast("string").cast("binary"))
                                        % FOLDS), ["_key", "_y", "_fold"], metadata)
    found = sorted(table.toLocalIterator(), key=lambda r: (r["_key"], r["data"]))
    y = np.array([r["_y"] for r in found], dtype=np.int64)
    calibrate = np.array([r["_fold"] == 0 for r in found], dtype=bool)
    parts = [np.frombuffer(r["data"], dtype=np.float64) for r in found]
    cut = [(int(p[0]), int(p[1])) for p in parts]

    def view(which: int) -> Sparse:
        sizes = [c[which] for c in cut]
        begins = [2 if which == 0 else 2 + 2 * c[0] for c in cut]
        places = [p[b:b + n] for p, b, n in zip(parts, begins, sizes, strict=True)]
        values = [p[b + n:b + 2 * n] for p, b, n in zip(parts, begins, sizes, strict=True)]
        empty = np.empty(0)
        return (np.concatenate(([0], np.cumsum(sizes))).astype(np.int64),
                np.concatenate([empty, *places]).astype(np.int64),
                np.concatenate([empty, *values]).astype(np.float32))

    model = co_train(view(0), view(1), y, calibrate, without)
    release(docs.sparkSession)
    return model


def _features(rows: DataFrame, keep: list[str], metadata: list[str]) -> DataFrame:
    """Both views of each row as one array: two sizes, then places and values of each view."""
    fields = rows.select(*keep).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text="_text", limit=1 << 20):
                (tf, tp, tv), (mf, mp, mv) = both_views(part, metadata)
                data = [
                    np.concatenate(([b - a, d - c], tp[a:b], tv[a:b], mp[c:d], mv[c:d])).tobytes()
                    for a, b, c, d in zip(tf[:-1], tf[1:], mf[:-1], mf[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(part[c] for c in keep), pa.array(data, pa.binary())], [*keep, "data"])

    return rows.mapInArrow(run, f"{_ddl(fields)}, data binary")


def _ddl(fields: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields.fields)


def both_views(part: pa.RecordBatch, metadata: list[str]) -> tuple[Sparse, Sparse]:
    return (text_features(texts_of(part, "_text")),
            meta_features([part[c].to_pylist() for c in metadata]))


def score_quality(docs: DataFrame, model: Views, metadata: list[str], text: str = "text",
                  keep: list[str] | None = None) -> DataFrame:
    """Score every row; the columns ``keep`` (default: all) stay, and three follow.

    ``text_score`` and ``meta_score`` are the calibrated probabilities of the two views, ``score``
    that of both together.  Rows are scored where they lie, without a shuffle.  A NULL or empty
    text has no words, a NULL metadata column is a value of its own; columns named like a result
    column are replaced.
    """
    kept = others(docs.columns if keep is None else keep, RESULT.names)
    fields = docs.select(*hidden(kept)).schema
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.text, model.meta, model.text_scale, model.meta_scale, model.both))

    def chance(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_w, meta_w, text_s, meta_s, both = shared.value
        for batch in batches:
            for part in slices(batch, text="_text", limit=1 << 20):
                one, two = both_views(part, [f"_m{i}" for i in range(len(metadata))])
                a, b = logits(one, text_w), logits(two, meta_w)
                scores = [chance(a * both[0] + b * both[1] + both[2]),
                          chance(a * text_s[0] + text_s[1]), chance(b * meta_s[0] + meta_s[1])]
                yield pa.RecordBatch.from_arrays(
                    [*(part[name] for name in fields.names), *map(pa.array, scores)],
                    [*fields.names, *RESULT.names])

    rows = docs.select(*hidden(kept), *(F.col(c).alias(f"_m{i}") for i, c in enumerate(metadata)),
                       F.col(text).alias("_text"))
    found = rows.mapInArrow(run, StructType(list(fields.fields) + list(RESULT.fields)))
    return found.select(*shown(kept), *RESULT.names)
