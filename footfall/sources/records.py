"""Records of CSV files that are read in splits, also inside quoted fields of many lines.

A split does not know whether it begins inside a quoted field, so both cases are followed; small
rows, one per split, put together per file, tell which one holds.  Within a batch of lines the
cases are followed by transition functions instead of a walk: a byte maps each state of a CSV
reader to the next one, functions compose, and the running compositions of a whole batch come
from table look-ups on arrays.
"""

import math
import sys
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.scratch import write_aside

# Tasks carry the code they run, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPLIT = ["file", "start", "length"]
#: Bytes of lines that are handed on as one row.
PIECE_BYTES = 4 << 20

# States: at the beginning of a field, in a plain one, in a quoted one, behind a quote in a quoted
# one.  A quote opens a field only as its first character, inside a quoted field two quotes are
# one, and what follows the closing quote up to the comma is plain.
_BEGIN, _PLAIN, _QUOTED, _CLOSING = range(4)
_OTHER, _QUOTE, _COMMA, _END = range(4)
_NEXT = {
    _OTHER: (_PLAIN, _PLAIN, _QUOTED, _PLAIN),
    _QUOTE: (_QUOTED, _PLAIN, _CLOSING, _QUOTED),
    _COMMA: (_BEGIN, _BEGIN, _QUOTED, _BEGIN),
    _END: (_BEGIN, _BEGIN, _QUOTED, _BEGIN),
}
#: A function of the four states is a byte, two bits for the value of each.
_FUNCTION = np.array([sum(to << 2 * state for state, to in enumerate(_NEXT[symbol]))
                      for symbol in range(4)], dtype=np.uint8)
_IDENTITY = sum(state << 2 * state for state in range(4))
_SYMBOL = np.full(256, _OTHER, dtype=np.uint8)
_SYMBOL[ord('"')], _SYMBOL[ord(",")] = _QUOTE, _COMMA


def _compositions() -> np.ndarray:
    """The function ``second after first`` at ``first * 256 + second``."""
    first, second = np.divmod(np.arange(1 << 16), 256)
    out = np.zeros(1 << 16, dtype=np.uint8)
    for state in range(4):
        between = (first >> 2 * state) & 3
        out |= (((second >> 2 * between) & 3) << 2 * state).astype(np.uint8)
    return out


_COMPOSED = _compositions()


def running_functions(functions: np.ndarray) -> np.ndarray:
    """The composition of all functions up to and with each.

    Rows of a square grid advance together, then what the rows before make is put in front.
    """
    n = len(functions)
    width = max(1, math.isqrt(n))
    rows = -(-n // width)
    grid = np.full(width * rows, _IDENTITY, dtype=np.uint16)
    grid[:n] = functions
    grid = grid.reshape(rows, width).T.copy()
    for i in range(1, width):
        grid[i] = _COMPOSED[(grid[i - 1] << 8) | grid[i]]
    table, before, so_far = _COMPOSED.tobytes(), [], _IDENTITY
    for total in grid[-1].tolist():
        before.append(so_far)
        so_far = table[so_far << 8 | total]
    front = np.array(before, dtype=np.uint16) << 8
    return _COMPOSED[front | grid].T.reshape(-1)[:n]


def line_functions(lines: pa.Array) -> np.ndarray:
    """The composition of the functions of all bytes up to the end of each line."""
    raw = lines.cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset:raw.offset + len(raw) + 1]
    content = raw.buffers()[2]
    symbols = (_SYMBOL[np.frombuffer(content, dtype=np.uint8)[offsets[0]:offsets[-1]]]
               if content is not None else np.empty(0, dtype=np.uint8))
    ends = offsets[1:] - offsets[0]
    # of neighbouring other bytes one is enough
    kept = np.ones(len(symbols), dtype=bool)
    kept[1:] = (symbols[1:] != _OTHER) | (symbols[:-1] != _OTHER)
    starts = ends[:-1][ends[:-1] < len(symbols)]
    kept[starts] = True
    at = np.concatenate(([0], np.cumsum(kept)))[ends]
    with_ends = np.insert(symbols[kept], at, _END)
    return running_functions(_FUNCTION[with_ends])[at + np.arange(len(at))]


class Run:
    """Reads the lines of one split, not knowing whether it begins inside a quoted field.

    Both cases are followed: how many records have begun, and whether a quoted field is open.
    """

    def __init__(self, cases: tuple[bool, ...] = (False, True)) -> None:
        self.seq, self.begun, self.quoted = 0, [0] * len(cases), list(cases)

    def begins(self, values: pa.Array) -> list[np.ndarray]:
        """Whether a record begins with each line, in each case."""
        has_quote = np.asarray(pc.match_substring(values, '"'))
        before = np.cumsum(has_quote) - has_quote  # lines with quotes before each line
        functions = line_functions(values.filter(pa.array(has_quote))) if has_quote.any() else None
        found = []
        for case, quoted in enumerate(self.quoted):
            after = np.array([quoted])
            if functions is not None:
                state = (functions >> 2 * (_QUOTED if quoted else _BEGIN)) & 3
                after = np.concatenate((after, state == _QUOTED))
            self.quoted[case] = bool(after[-1])
            found.append(~after[before])
        self.seq += len(values)
        return found

    def add(self, values: pa.Array) -> list[np.ndarray]:
        """Records begun up to and with each line, in each case."""
        out = []
        for case, begins in enumerate(self.begins(values)):
            out.append(self.begun[case] + np.cumsum(begins))
            self.begun[case] += int(begins.sum())
        return out


def runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple, Run, pa.RecordBatch, int]]:
    """Pieces of batches that belong to one split, with that split's run."""
    split, run = None, Run()
    for batch in batches:
        keys = list(zip(*(batch[name].to_pylist() for name in SPLIT), strict=True))
        cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            if keys[a] != split:
                split, run = keys[a], Run()
            yield split, run, batch.slice(a, b - a), run.seq


_STATES = ("file string, start long, length long, n_out long, n_in long, end_out int, end_in int, "
           "header string")


def _states(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: the records that begin in it and how it ends, in both cases; and of a file's
    first split the first record, if it ends there."""
    last: dict[tuple, Run] = {}
    headers: dict[tuple, list[str]] = {}
    for split, run, piece, _ in runs(batches):
        n_out, _ = run.add(piece["value"])
        last[split] = run
        if split[1] == 0 and n_out[0] == 1:
            first = piece["value"].slice(0, int(np.searchsorted(n_out, 1, side="right")))
            headers.setdefault(split, []).extend(first.to_pylist())
    rows = []
    for split, run in last.items():
        whole = split in headers and (run.begun[0] > 1 or not run.quoted[0])
        rows.append((*split, *run.begun, *map(int, run.quoted), "\n".join(headers[split]) if whole else None))
    names = [field.split()[0] for field in _STATES.split(", ")]
    kinds = {"file": pa.string(), "header": pa.string(), "end_out": pa.int32(), "end_in": pa.int32()}
    yield pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True)) for row in rows],
                                     schema=pa.schema([(n, kinds.get(n, pa.int64())) for n in names]))


def _composed(splits):
    """For the splits of one file: whether each begins quoted, and the records before it."""
    splits = splits.sort_values("start")
    quoted, before, begins, earlier = 0, 0, [], []
    for row in splits.itertuples():
        begins.append(quoted)
        earlier.append(before)
        before += row.n_in if quoted else row.n_out
        quoted = row.end_in if quoted else row.end_out
    return splits[[*SPLIT, "header"]].assign(quoted=begins, before=earlier, records=before)


def split_lines(spark: SparkSession, *sources: str) -> DataFrame:
    """The lines of text files, with the split that each is in."""
    return (
        spark.read.options(lineSep="\n", recursiveFileLookup=True).text(list(sources))
        .select("value", F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("start"),
                F.col("_metadata.file_block_length").alias("length"))
    )


def split_index(lines: DataFrame) -> DataFrame:
    """For each split whether it begins quoted and the file's records before it; the file's records in all;
    and for a file's first split its first record, NULL if that goes on in the next one.

    One pass over the text, written aside.
    """
    return write_aside(
        lines.mapInArrow(_states, _STATES).groupBy("file").applyInPandas(
            _composed, "file string, start long, length long, header string, quoted int, before long, records long"),
        "splits")


_PIECES = ("file string, start long, length long, piece long, lines array<string>, begun_out long, "
           "begun_in long, quoted_out boolean, quoted_in boolean")


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of a split, some together, with how they begin in both cases."""
    for split, run, part, seq in runs(batches):
        sizes = np.cumsum(np.asarray(pc.binary_length(part["value"]), dtype=np.int64) + 1)
        at = 0
        while at < part.num_rows:
            done = sizes[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, done + PIECE_BYTES, side="right")))
            values = part["value"].slice(at, to - at)
            begun, quoted = list(run.begun), list(run.quoted)
            run.add(values)
            lines = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.concat_arrays([values]))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([key]) for key in split), pa.array([seq + at]), lines, pa.array(begun[:1]),
                 pa.array(begun[1:]), pa.array(quoted[:1]), pa.array(quoted[1:])],
                [field.split()[0] for field in _PIECES.split(", ")])
            at = to


_RECORDS = "file string, start long, piece long, record long, value string"


def _records(batches: Iterable[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    """The records that lie in one piece, or the parts of those that other pieces go on with."""
    for batch in batches:
        for i in range(batch.num_rows):
            quoted = batch["quoted"][i].as_py()
            if quoted is None:
                raise ValueError("the files were cut differently in the second pass")
            case = "in" if quoted else "out"
            lines = batch["lines"][i].values
            begun = batch["before"][i].as_py() + batch[f"begun_{case}"][i].as_py()
            run = Run((batch[f"quoted_{case}"][i].as_py(),))
            starts = np.flatnonzero(run.begins(lines)[0])
            head = not len(starts) or starts[0] > 0
            cuts = np.concatenate(([0] if head else [], starts, [len(lines)])).astype(np.int32)
            kept = np.ones(len(cuts) - 1, dtype=bool)
            kept[0] &= not head
            kept[-1] &= not run.quoted[0]
            at = np.flatnonzero(kept == whole)
            if not len(at):
                continue
            record = pa.array((begun - head + at).astype(np.int64))
            texts = _joined(lines, cuts, at)
            here = [pa.array([batch[name][i].as_py()] * len(at), kind)
                    for name, kind in (("file", pa.string()), ("start", pa.int64()), ("piece", pa.int64()))]
            yield pa.RecordBatch.from_arrays([*here, record, texts], ["file", "start", "piece", "record", "value"])


def _joined(lines: pa.Array, cuts: np.ndarray, at: np.ndarray) -> pa.Array:
    """The lines from ``cuts[i]`` to before ``cuts[i + 1]`` as one text, for each i of ``at``."""
    if len(at) < 3:
        return pa.array(["\n".join(lines.slice(cuts[i], cuts[i + 1] - cuts[i]).to_pylist()) for i in at], pa.string())
    begin, end = int(cuts[at[0]]), int(cuts[at[-1] + 1])  # those of whole records are next to each other
    offsets = pa.array(np.append(cuts[at], end) - begin, pa.int32())
    values = pa.concat_arrays([lines.slice(begin, end - begin)])
    return pc.binary_join(pa.ListArray.from_arrays(offsets, values), "\n")


def csv_records(spark: SparkSession, *sources: str) -> DataFrame:
    """``file``, ``record`` (its number in the file from 0 on) and ``value`` (its text) of all records.

    Files are read in splits of any place, so one large file is read by many tasks.  A first pass
    finds how each split begins.  Records whose lines lie in one piece of a split need no
    shuffle; of those that are cut by the end of a piece only the parts are brought together,
    in a scan of their own.
    """
    lines = split_lines(spark, *sources)
    known = split_index(lines).drop("records", "header")
    pieces = lines.mapInArrow(_pieces, _PIECES).join(known, SPLIT, "left")
    cut = (
        pieces.mapInArrow(partial(_records, whole=False), _RECORDS).groupBy("file", "record")
        .agg(F.array_sort(F.collect_list(F.struct("start", "piece", "value"))).alias("parts"))
        .select("file", "record", F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value"))
    )
    whole = pieces.mapInArrow(partial(_records, whole=True), _RECORDS)
    return whole.select("file", "record", "value").unionByName(cut)
