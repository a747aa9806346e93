"""Chunks of documents, and the exchange by which chunks ask about hashes of the whole corpus.

Counting every window or n-gram of a corpus as one Spark row each would shuffle some forty
bytes per word.  Here a task reduces a chunk of documents to sorted distinct hashes, cuts these
by hash into buckets and ships each piece as one binary value.  A bucket merges the pieces of
all chunks and answers each chunk.  Whatever repeats within a chunk travels once, so a key
that holds a third of all rows costs one entry per chunk, and every task reads about the same.

Chunks are written to the shared folder first: they keep their numbers when a task is repeated
or an executor is lost.
"""

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from footfall.scratch import new_folder

CHUNK_BYTES = 1 << 20
BUCKET_BYTES = 16 << 20
LEAST_BUCKET_BYTES = 1 << 16
ROW_GROUP_BYTES = 4 << 20
CHUNK_SCHEMA = "chunk long, n_rows long, n_bytes long, data binary"

def slices(batch: pa.RecordBatch, text: str = "text",
           limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into parts whose texts have about ``limit`` bytes; a longer text is one part."""
    sizes = pc.fill_null(pc.binary_length(batch[text].cast(pa.large_binary())), 0)
    ends = np.cumsum(np.asarray(sizes, dtype=np.int64) + 64)
    at = 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def texts_of(batch: pa.RecordBatch, text: str = "text") -> list[bytes | None]:
    return batch[text].cast(pa.large_binary()).to_pylist()


def packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_next_batch()


def write_chunks(docs: DataFrame, purpose: str, limit: int = CHUNK_BYTES) -> DataFrame:
    """Write ``docs``, which has a column ``text``, as numbered chunks of compressed rows."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, limit=limit):
                data = packed(part)
                yield pa.RecordBatch.from_pydict({
                    "chunk": [number], "n_rows": [part.num_rows],
                    "n_bytes": [sum(len(t or b"") for t in texts_of(part))],
                    "data": pa.array([data], pa.binary()),
                })
                number += 1

    return write_blobs(docs.mapInArrow(pack, CHUNK_SCHEMA), purpose, compression="uncompressed")


def write_blobs(df: DataFrame, purpose: str, compression: str = "snappy") -> DataFrame:
    """Write rows with large binary values to a fresh shared folder and read them back.

    Parquet's writer looks at the size of a page only every hundred rows by default, and the reader
    holds a batch of up to 4096 rows of a row group; with values of half a megabyte both would
    take much of an executor's memory, so pages and row groups are kept small.
    """
    folder = new_folder(df.sparkSession, purpose)
    df.write.options(**{"compression": compression, "parquet.page.size.row.check.min": 1,
                        "parquet.page.size.row.check.max": 16,
                        "parquet.block.size": ROW_GROUP_BYTES}).parquet(folder)
    return df.sparkSession.read.parquet(folder)


def bucket_count(spark: SparkSession, n_bytes: int, least: int = LEAST_BUCKET_BYTES) -> int:
    """Buckets of bounded size, and enough of them to level out over the shuffle partitions, unless
    they would hold next to nothing (below ``least``)."""
    even = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(min(even, 1 + n_bytes // least), -(-n_bytes // BUCKET_BYTES))


def bucket_of(hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    """The bucket of each hash, from its upper half; sorted hashes have ascending buckets."""
    return ((hashes >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)


def bucket_cuts(ascending: np.ndarray, n_buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted hashes; one entry more ends the last."""
    return np.searchsorted(bucket_of(ascending, n_buckets), np.arange(n_buckets + 1))


def chunk_rows(chunks: DataFrame, task: Callable[[int, pa.RecordBatch], Iterable[dict]],
               schema: str | StructType) -> DataFrame:
    """Rows that ``task(chunk, documents)`` makes of each chunk, as dicts of columns."""
    schema, columns = _schemas(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, data in zip(batch["chunk"], batch["data"], strict=True):
                for part in task(chunk.as_py(), unpacked(data.as_buffer())):
                    yield pa.RecordBatch.from_pydict(part, schema=columns)
                give_back()

    return chunks.select("chunk", "data").mapInArrow(run, schema)


def bucket_rows(asked: DataFrame, task: Callable[[pa.Table], dict],
                schema: str | StructType) -> DataFrame:
    """Rows that ``task`` makes of all rows of a bucket."""
    schema, columns = _schemas(schema)

    def run(table: pa.Table) -> pa.Table:
        give_back()
        return pa.Table.from_pydict(task(table), schema=columns)

    return asked.groupBy("bucket").applyInArrow(run, schema)


def answered_rows(chunks: DataFrame, answers: DataFrame,
                  task: Callable[[int, pa.RecordBatch, pa.Table], dict],
                  schema: str | StructType) -> DataFrame:
    """Rows that ``task(chunk, documents, answers)`` makes of each chunk and its answers."""
    schema, columns = _schemas(schema)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        give_back()
        parts = [task(chunk.as_py(), unpacked(data.as_buffer()), right)
                 for chunk, data in zip(left["chunk"], left["data"], strict=True)]
        tables = [pa.Table.from_pydict(part, schema=columns) for part in parts]
        return pa.concat_tables(tables) if tables else columns.empty_table()

    return (
        chunks.select("chunk", "data").groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(run, schema)
    )


def give_back() -> None:
    """Return freed memory to the system, which allocators else keep.

    A worker goes on to other tasks, and those of an executor would each hold what their largest
    chunk once took.
    """
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # glibc alone has this call
        ctypes.CDLL(None).malloc_trim(0)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of steps whose results have been written.

    Spark removes them when the driver's JVM collects the plans that made them, which a long job
    with few objects may put off until its end.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small_counts(values: np.ndarray) -> bytes:
    """Counts of one byte each; 255 stands for a larger one, which follows at the end."""
    large = values >= 255
    return np.minimum(values, 255).astype("u1").tobytes() + values[large].astype("<u8").tobytes()


def counts_of(value: pa.Scalar, n: int) -> np.ndarray:
    """The ``n`` counts that :func:`small_counts` packed."""
    raw = numbers(value, "u1")
    out = raw[:n].astype(np.int64)
    out[out == 255] = np.frombuffer(raw[n:].tobytes(), dtype="<u8")
    return out


def numbers(value: pa.Scalar, dtype: str) -> np.ndarray:
    """A binary value as an array."""
    return np.frombuffer(value.as_buffer(), dtype=dtype) if value.is_valid else np.empty(0, dtype)


def _schemas(schema: str | StructType) -> tuple[StructType, pa.Schema]:
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return schema, to_arrow_schema(schema)


def others(columns: list[str], names: Iterable[str]) -> list[str]:
    """The columns that are not named like one of ``names``, compared as Spark does, without regard to
    case."""
    taken = {name.lower() for name in names}
    return [column for column in columns if column.lower() not in taken]


def hidden(kept: list[str]) -> list[Column]:
    """A caller's columns under names that no operator uses."""
    return [F.col(f"`{name}`").alias(f"_k{i}") for i, name in enumerate(kept)]


def shown(kept: list[str]) -> list[Column]:
    """The columns of :func:`hidden` under their own names."""
    return [F.col(f"_k{i}").alias(name) for i, name in enumerate(kept)]


def crc_rest(column: Column | str, divisor: int) -> Column:
    """crc32 of a number's text, modulo ``divisor``; NULL for NULL."""
    column = F.col(column) if isinstance(column, str) else column
    return F.crc32(column.cast("string").cast("binary")) % divisor
