"""Language ID: TF-IDF vectors of character n-grams and the nearest of several centroids."""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from footfall.llm.exchange import hidden, others, shown, slices

DIMENSIONS = 4096
ORDERS = (1, 2, 3)
CENTROIDS = 4
#: Bound of the labelled rows that the centroids are fitted to, over all languages together.
FIT_ROWS = 4000
STEPS = 12
#: Unit vectors of a batch that are held at once.
ROWS_AT_ONCE = 256
TEXT_BYTES = 1 << 20
#: Counts of languages are broadcast up to so many.
BROADCAST_LANGS = 100_000
#: Classes of texts by powers of two of their distinct n-grams, which a repeated word adds none to.
CLASSES = DIMENSIONS.bit_length()
#: At most this part of a language's rows is fitted to, so that others remain to be compared.
FIT_PART = 0.8
#: A text is rejected below this part of the low tail (quantile) of the cosines of training rows of
#: its language and class that the centroids were not fitted to; classes with fewer than
#: ``ENOUGH`` of them use their neighbours' too.
REJECT_PART, TAIL, ENOUGH = 0.85, 0.001, 200
BINS = 400
UNDETERMINED = "und"


def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def grams(texts: list[str | None], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed n-grams of each text, and its number of letters.

    Texts are lower-cased; every other character counts as a blank, and blanks in a row as one.
    """
    codes = [np.frombuffer((" " + (t or "").lower() + " ").encode("utf-32-le"), dtype=np.uint32)
             for t in texts]
    text = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
    flat = np.concatenate(codes) if codes else np.empty(0, dtype=np.uint32)
    is_letter = letters[flat]
    n_letters = np.bincount(text, weights=is_letter, minlength=len(texts)).astype(np.int64)
    starts = np.concatenate(([True], text[1:] != text[:-1])) if len(text) else np.empty(0, bool)
    before = np.concatenate(([False], is_letter[:-1])) if len(text) else is_letter
    used = is_letter | before | starts
    flat, text = np.where(is_letter, flat, 32)[used].astype(np.uint64), text[used]
    counts = np.zeros(len(texts) * DIMENSIONS, dtype=np.float32)
    for n in ORDERS:
        if len(flat) < n:
            continue
        size = len(flat) - n + 1
        key = np.full(size, n, dtype=np.uint64)
        for i in range(n):
            key = key * np.uint64(0x100000001B3) + flat[i:i + size]
        key *= np.uint64(0x9E3779B97F4A7C15)
        place = (key >> np.uint64(52)).astype(np.int64) + text[:size] * DIMENSIONS
        place = place[text[:size] == text[n - 1:]]
        counts += np.bincount(place, minlength=len(counts)).astype(np.float32)
    return counts.reshape(len(texts), DIMENSIONS), n_letters


def unit_vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weighted = np.log1p(counts) * idf
    size = np.linalg.norm(weighted, axis=1, keepdims=True)
    return weighted / np.where(size > 0, size, 1)


@dataclass
class Centroids:
    """``langs[i]`` is the language of row ``i`` of ``vectors``; ``least`` the smallest cosine
    to the nearest of them with which a text is accepted, for each row and class of texts or one
    number for all."""

    langs: list[str]
    vectors: np.ndarray
    idf: np.ndarray
    least: np.ndarray | float


def _parts(batches: Iterable[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Few rows and few bytes of texts at a time; one long text is a part of its own."""
    for batch in batches:
        for big in slices(batch, text=text, limit=TEXT_BYTES):
            for at in range(0, big.num_rows, ROWS_AT_ONCE):
                yield big.slice(at, ROWS_AT_ONCE)


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """In how many texts each hashed n-gram occurs, over all rows, and the number of rows."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, found, rows = _letters(), np.zeros(DIMENSIONS, dtype=np.int64), 0
        for part in _parts(batches):
            counts, _ = grams(part["text"].to_pylist(), letters)
            found += (counts > 0).sum(axis=0)
            rows += len(counts)
        yield pa.RecordBatch.from_pydict({"dim": np.arange(-1, DIMENSIONS),
                                          "n": np.concatenate(([rows], found))})

    sums = (
        docs.select(F.col(text).alias("text")).mapInArrow(count, "dim long, n long")
        .groupBy("dim").agg(F.sum("n").alias("n")).collect()
    )
    found = np.zeros(DIMENSIONS + 1, dtype=np.int64)
    for row in sums:
        found[row.dim + 1] = row.n
    return found[1:], int(found[0])


def _place(text: str, order: str) -> Column:
    """Where a row stands in the choice of rows; rows without an ``order`` go by their text."""
    return F.when(F.col(order).isNull(), F.xxhash64(F.col(text), F.lit(7))).otherwise(
        F.xxhash64(F.col(order), F.lit(7)))


def fit_rows(docs: DataFrame, text: str, lang: str, order: str, bound: int) -> DataFrame:
    """At most ``bound`` rows (or one for each language, if there are more of these), evenly over the
    languages and the same ones whenever asked.

    Rows are taken by a hash of ``order``, at most ``FIT_PART`` of a language's; a first cut by hash
    keeps the ranking of a frequent language small.  Of rows with the same hash one is taken, the
    same one always.
    """
    totals = docs.groupBy(lang).agg(F.count(F.lit(1)).alias("_total"))
    n_langs = totals.count()
    if n_langs <= BROADCAST_LANGS:
        totals = F.broadcast(totals)
    each = max(1, bound // max(1, n_langs))
    share = F.pmod("_place", F.lit(1 << 30)) / (1 << 30)
    few = (
        docs.join(totals, lang).withColumn("_place", _place(text, order))
        .where(share <= F.lit(2.0 * each + 64) / F.col("_total"))
        .groupBy(lang, "_place").agg(F.first("_total").alias("_total"),
                                     F.min_by(text, F.xxhash64(text)).alias(text))
    )
    size = F.least(F.lit(each), F.ceil(F.first("_total") * FIT_PART)).cast("int")
    picked = few.groupBy(lang).agg(F.slice(F.sort_array(F.collect_list("_place")), F.lit(1), size)
                                   .alias("_taken"))
    return (
        few.join(picked, lang).where(F.array_contains("_taken", F.col("_place")))
        .drop("_taken", "_total")
    )


def _cluster(vectors: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from the vectors least like those already chosen."""
    centers = [_unit(vectors.mean(axis=0))]
    near = vectors @ centers[0]
    for _ in range(min(k, len(vectors)) - 1):
        centers.append(vectors[int(np.argmin(near))])
        near = np.maximum(near, vectors @ centers[-1])
    center = np.array(centers)
    for _ in range(STEPS):
        own = np.argmax(vectors @ center.T, axis=1)
        center = np.array([_unit(vectors[own == i].sum(axis=0)) if (own == i).any() else center[i]
                           for i in range(len(center))])
    return center


def _unit(vector: np.ndarray) -> np.ndarray:
    return vector / max(float(np.linalg.norm(vector)), 1e-12)


def learn(train: DataFrame, text: str = "text", lang: str = "lang", order: str = "doc_id",
          centroids: int = CENTROIDS, bound: int = FIT_ROWS) -> Centroids:
    """Fit the model to labelled rows.

    Document frequencies come from all rows of ``train`` with a language; the centroids from at
    most ``bound`` rows of them (see :func:`fit_rows`), whose vectors tasks compute and cluster, a
    language in each; the least cosines from all other rows.
    """
    train = train.where(F.col(lang).isNotNull())
    found, rows = document_frequencies(train, text)
    idf = (np.log((rows + 1) / (found + 1)) + 1).astype(np.float32)

    def vectors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _letters()
        for part in _parts(batches):
            counts, n_letters = grams(part["text"].to_pylist(), letters)
            data = [v.astype("<f4").tobytes() if n else None
                    for v, n in zip(unit_vectors(counts, idf), n_letters, strict=True)]
            yield pa.RecordBatch.from_pydict({"lang": part["lang"].cast(pa.string()),
                                              "_place": part["_place"],
                                              "data": pa.array(data, pa.binary())})

    def cluster(rows: pa.Table) -> pa.Table:
        """The centroids of a language, the places of the rows they are fitted to with the first."""
        order = np.argsort(rows["_place"].to_numpy())
        joined = b"".join(rows["data"].take(pa.array(order)).to_pylist())
        own = np.frombuffer(joined, dtype="<f4").reshape(len(order), DIMENSIONS)
        centers = [center.astype("<f4").tobytes() for center in _cluster(own, centroids)]
        places = [rows["_place"].to_pylist(), *([[]] * (len(centers) - 1))]
        return pa.table({"lang": [rows["lang"][0].as_py()] * len(centers), "n": range(len(centers)),
                         "center": pa.array(centers, pa.binary()),
                         "places": pa.array(places, pa.list_(pa.int64()))})

    sample = fit_rows(train.select(F.col(text).alias("text"), F.col(lang).alias("lang"),
                                   F.col(order).alias("order")), "text", "lang", "order", bound)
    made = sample.select("lang", "_place", "text").mapInArrow(
        vectors, "lang string, _place long, data binary").where("data IS NOT NULL")
    found = made.groupBy("lang").applyInArrow(
        cluster, "lang string, n long, center binary, places array<long>").collect()
    found.sort(key=lambda row: (row["lang"], row["n"]))
    langs = [row["lang"] for row in found]
    centers = [np.frombuffer(row["center"], dtype="<f4")[None] for row in found]
    taken = [place for row in found for place in row["places"]]
    model = Centroids(langs, np.concatenate(centers) if centers else np.zeros((0, DIMENSIONS)), idf, 0.0)
    if langs:
        others = train.select(F.col(text).alias("text"), _place(text, order).alias("_place"))
        model.least = least_cosines(cosine_counts(others, model, np.array(taken)), langs)
    return model


def text_class(counts: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum((counts > 0).sum(axis=1), 1)).astype(np.int64)


def cosine_counts(rows: DataFrame, model: Centroids, taken: np.ndarray) -> np.ndarray:
    """How many of all rows but those ``taken`` have a cosine in each bin, by the language of the
    nearest centroid (by name) and class of text."""
    names = sorted(set(model.langs))
    shape = (len(names), CLASSES, BINS)
    of_center = np.array([names.index(name) for name in model.langs])
    shared = rows.sparkSession.sparkContext.broadcast((model.vectors, model.idf, of_center, taken))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centers, idf, of_center, taken = shared.value
        letters, found = _letters(), np.zeros(shape, dtype=np.int64)
        for part in _parts(batches):
            part = part.filter(pa.array(~np.isin(np.asarray(part["_place"]), taken)))
            counts, n_letters = grams(part["text"].to_pylist(), letters)
            counts = counts[n_letters > 0]
            cosine = unit_vectors(counts, idf) @ centers.T
            bins = np.clip(cosine.max(axis=1) * BINS, 0, BINS - 1).astype(np.int64)
            np.add.at(found, (of_center[cosine.argmax(axis=1)], text_class(counts), bins), 1)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_pydict({"at": at, "n": found.ravel()[at]})

    total = np.zeros(shape, dtype=np.int64)
    for row in rows.mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        total.ravel()[row["at"]] = row["n"]
    return total


def least_cosines(counts: np.ndarray, langs: list[str]) -> np.ndarray:
    """For each centroid and class of texts, the least cosine that is accepted.

    A class without enough rows takes in those next to it.  The cosine of a short text falls with
    the root of its distinct n-grams at most, so it is held to that part of what longer ones reach.
    A language without any row takes those of all languages.
    """
    names = sorted(set(langs))
    values = np.arange(BINS) / BINS
    least = np.zeros((len(names), CLASSES))
    for i, own in enumerate(counts):
        own = own if own.any() else counts.sum(axis=0)
        for j in range(CLASSES):
            apart = np.abs(np.arange(CLASSES) - j)
            reach = next((r for r in range(CLASSES) if own[apart <= r].sum() >= ENOUGH), CLASSES)
            part = np.sqrt(0.5 ** np.maximum(np.arange(CLASSES) - j, 0))
            value = (values * part[:, None])[apart <= reach].ravel()
            n = own[apart <= reach].ravel()
            order = np.argsort(value)
            sums = np.cumsum(n[order])
            if sums[-1]:
                least[i, j] = value[order][np.searchsorted(sums, TAIL * sums[-1], side="right")]
    return REJECT_PART * least[[names.index(name) for name in langs]]


RESULT = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType()),
                     StructField("rejected", BooleanType())])


def identify(docs: DataFrame, model: Centroids, text: str = "text",
             keep: list[str] | None = None) -> DataFrame:
    """Predict the language of every whole text; the columns ``keep`` (default: all) stay.

    ``lang_pred`` is the language of the centroid with the largest cosine (the first by name of
    equal ones), or ``und`` for a NULL text, a text without a letter, or a model without
    centroids.  ``score`` is that cosine, from 0 to 1.  ``rejected`` tells whether the text is
    undetermined or farther from every centroid than the model accepts in a text with so many
    distinct n-grams.

    Rows are judged where they lie, without a shuffle; columns named like a result column are
    replaced.
    """
    kept = others(docs.columns if keep is None else keep, RESULT.names)
    rows = docs.select(*hidden(kept), F.col(text).alias("_text"))
    fields = rows.drop("_text").schema
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.langs, model.vectors, model.idf, model.least))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, centers, idf, least = shared.value
        letters = _letters()
        for batch in batches:
            for big in slices(batch, text="_text", limit=1 << 20):
                for at in range(0, big.num_rows, ROWS_AT_ONCE):
                    part = big.slice(at, ROWS_AT_ONCE)
                    counts, n_letters = grams(part["_text"].to_pylist(), letters)
                    names, score = [UNDETERMINED] * part.num_rows, np.zeros(part.num_rows)
                    rejected = n_letters == 0
                    if not langs:
                        rejected[:] = True
                    else:
                        cosine = unit_vectors(counts, idf) @ centers.T
                        best = np.argmax(cosine, axis=1)
                        score = np.clip(cosine[np.arange(len(best)), best], 0, 1).astype(float)
                        score[n_letters == 0] = 0
                        rejected |= score < np.broadcast_to(least, (len(langs), CLASSES))[
                            best, text_class(counts)]
                        names = [langs[b] if n else UNDETERMINED
                                 for b, n in zip(best, n_letters, strict=True)]
                    rest = part.drop_columns(["_text"])
                    yield pa.RecordBatch.from_arrays(
                        [*rest.columns, pa.array(names, pa.string()), pa.array(score, pa.float64()),
                         pa.array(rejected, pa.bool_())],
                        [*rest.schema.names, *RESULT.names])

    found = rows.mapInArrow(run, StructType(list(fields.fields) + list(RESULT.fields)))
    return found.select(*shown(kept), *RESULT.names)
