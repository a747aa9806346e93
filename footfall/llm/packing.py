"""Packing: documents as tokens in sequences of bounded length, by minimum bin slack."""

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from footfall.llm.exchange import hidden, others, shown, slices, texts_of
from footfall.llm.words import Words, words_of

CAPACITY = 2048
END_ID = 1
#: Remainders that a task gathers before it fills sequences.
WINDOW_PIECES = 4096
KNOWN_WORDS = 1_000_000
#: Words of a-z and the letters of Latin-1 beyond ASCII, in UTF-8.
LATIN = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


_BYTES = np.arange(256)
_LETTER = ((_BYTES | 32) >= 0x61) & ((_BYTES | 32) <= 0x7A) & (_BYTES < 0x80)
_SIGN = (_BYTES > 0x20) & (_BYTES < 0x7F) & ~_LETTER


class WordTokenizer:
    """Token ids of texts, for tokenizers that lower-case and cut at ASCII blanks and between an
    ASCII letter and a following ASCII digit or sign.

    Words are looked up by hash; those not met before are encoded by the library together.  Words
    of Latin letters are joined by blanks, and each one's ids end with its only token that ends
    a word; between other words there is a special token, at which the ids are cut apart.  A batch
    that holds the beginning of a special token's text is encoded text by text.  Once the memory
    of known words is full, further words are encoded anew for each batch.
    """

    def __init__(self, file: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        special = {id_: token.content for id_, token in self.tokenizer.get_added_tokens_decoder().items()
                   if token.special}
        self.mark, self.mark_id = min((text, id_) for id_, text in special.items())
        self.opening = {text[:2].encode() for text in special.values()}
        vocabulary = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.is_end[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        #: Sorted hashes, the number of each one's entry, and the entries: where its ids are.
        self.known = np.empty(0, dtype=np.uint64)
        self.entry = np.empty(0, dtype=np.int64)
        self.place = np.empty(0, dtype=np.int64)
        self.size = np.empty(0, dtype=np.int64)
        self.flat = np.empty(0, dtype=np.uint32)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, self.entry[at], -1)

    def _encode(self, texts: list[bytes], joint: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(
            joint.encode().join(texts).decode(), add_special_tokens=False).ids, dtype=np.uint32)

    def _word_ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of words, and where each word's begin and end."""
        latin = np.array([LATIN.fullmatch(text) is not None for text in texts], dtype=bool)
        latin &= self.is_end.any()
        flat, begin, end = [], np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
        done = 0
        for rows, joint in ((np.flatnonzero(latin), " "), (np.flatnonzero(~latin), self.mark)):
            if not len(rows):
                continue
            own = [texts[i] for i in rows.tolist()]
            ids = self._encode(own, joint)
            if joint == " ":
                to = np.flatnonzero(self.is_end[ids]) + 1
                at = np.concatenate(([0], to[:-1]))
                if len(to) != len(rows):
                    raise ValueError("the tokenizer does not mark where words end")
            else:
                cuts = np.flatnonzero(ids == self.mark_id)
                at, to = np.concatenate(([0], cuts + 1)), np.concatenate((cuts, [len(ids)]))
            begin[rows], end[rows] = at + done, to + done
            flat.append(ids)
            done += len(ids)
        return np.concatenate(flat), begin, end

    def _learn(self, words: Words, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Encode words, given their hashes and where one of each is; the numbers of their entries."""
        ids, begin, end = self._word_ids([words.word(i) for i in first.tolist()])
        numbers = np.arange(len(hashes)) + len(self.place)
        self.place = np.concatenate((self.place, begin + len(self.flat)))
        self.size = np.concatenate((self.size, end - begin))
        self.flat = np.concatenate((self.flat, ids))
        at = np.searchsorted(self.known, hashes)
        self.known, self.entry = np.insert(self.known, at, hashes), np.insert(self.entry, at, numbers)
        return numbers

    def ids(self, texts: list[bytes | None], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32), each text's closed by ``end_id``, and where each text's begin."""
        if any(o in text for text in texts if text for o in self.opening):
            return self._special_ids(texts, end_id)
        words = words_of(texts, lower=True, cut=(_LETTER, _SIGN))
        at = self._find(words.hashes)
        new = np.flatnonzero(at < 0)
        before = self.known, self.entry, self.place, self.size, self.flat
        if len(new):
            hashes, first, which = np.unique(words.hashes[new], return_index=True, return_inverse=True)
            at[new] = self._learn(words, hashes, new[first])[which]
        size = self.size[at]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.place[at] - (ends - size), size) + np.arange(total)]
        if len(self.known) > KNOWN_WORDS:
            self.known, self.entry, self.place, self.size, self.flat = before
        begins = np.concatenate(([0], ends))[words.first]
        return _closed(ids, begins, end_id)

    def _special_ids(self, texts: list[bytes | None], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch(
            [(t or b"").decode() for t in texts], add_special_tokens=False)]
        begins = np.concatenate(([0], np.cumsum([len(f) for f in found])))
        return _closed(np.array([i for f in found for i in f], dtype=np.uint32), begins, end_id)


def _closed(ids: np.ndarray, begins: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` after each text's."""
    n = len(begins) - 1
    out = np.full(len(ids) + n, end_id, dtype="<u4")
    out[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(begins))] = ids
    return out, begins + np.arange(n + 1)


def fill(counts: np.ndarray, capacity: int) -> dict[int, int]:
    """The multiset of lengths, at most ``counts[length]`` of each, with the largest sum up to
    ``capacity`` among those that hold the longest one.

    A bitset has a bit for each reachable sum.  Lengths are added from the longest down, each in
    groups of 1, 2, 4, ... pieces; the sets before each group lead back from the best sum to
    how many pieces of each length it takes.
    """
    longest = int(np.flatnonzero(counts)[-1])
    space = capacity - longest
    full, reach, steps = (1 << (space + 1)) - 1, 1, []
    fitting = np.flatnonzero(counts[:space + 1])[::-1]
    for length, n in zip(fitting.tolist(), counts[fitting].tolist(), strict=True):
        left = min(n - (length == longest), space // length)
        group = 1
        while left > 0:
            group = min(group, left)
            steps.append((reach, length, group))
            reach |= (reach << (length * group)) & full
            left -= group
            group *= 2
        if reach >> space & 1:
            break
    at = reach.bit_length() - 1
    taken = {longest: 1}
    for before, length, group in reversed(steps):
        if not before >> at & 1:
            taken[length] = taken.get(length, 0) + group
            at -= length * group
    return taken


def powers_of_two(total: int) -> list[int]:
    """``total`` as a sum of falling powers of two."""
    return [1 << bit for bit in reversed(range(total.bit_length())) if total >> bit & 1]


class Packer:
    """Packs the pieces of one task; a piece is (document, start, ids)."""

    def __init__(self, capacity: int, number: int) -> None:
        self.capacity, self.number = capacity, number
        self.waiting: list[list] = [[] for _ in range(capacity)]
        self.counts = np.zeros(capacity, dtype=np.int64)
        self.n_waiting = 0
        self.rows: list[tuple] = []

    def add(self, doc: tuple, ids: np.ndarray) -> None:
        """Full sequences go out at once, the remainder waits."""
        full = len(ids) // self.capacity * self.capacity
        for start in range(0, full, self.capacity):
            self._emit([(doc, start, ids[start:start + self.capacity])])
        if full < len(ids):
            self._wait((doc, full, ids[full:].copy()))

    def _wait(self, piece: tuple) -> None:
        self.waiting[len(piece[2])].append(piece)
        self.counts[len(piece[2])] += 1
        self.n_waiting += 1

    def _take(self, length: int) -> tuple:
        self.counts[length] -= 1
        self.n_waiting -= 1
        return self.waiting[length].pop()

    def pack(self, leave: int = 0) -> None:
        """Fill sequences until no more than ``leave`` pieces wait.

        What a fill lacks is cut from the shortest waiting piece that is longer.  When all that
        waits is shorter than a sequence, it is cut at powers of two, which need no padding.
        """
        while self.n_waiting > leave:
            taken = fill(self.counts, self.capacity)
            pieces = [self._take(length) for length, n in taken.items() for _ in range(n)]
            gap = self.capacity - sum(len(ids) for _, _, ids in pieces)
            longer = np.flatnonzero(self.counts[gap + 1:]) if gap else []
            if len(longer):
                doc, start, ids = self._take(gap + 1 + int(longer[0]))
                pieces.append((doc, start, ids[:gap]))
                self._wait((doc, start + gap, ids[gap:]))
                gap = 0
            if not gap:
                self._emit(pieces)
            else:
                self._emit_powers(pieces)

    def _emit_powers(self, pieces: list[tuple]) -> None:
        for room in powers_of_two(sum(len(ids) for _, _, ids in pieces)):
            part = []
            while room:
                doc, start, ids = pieces.pop()
                part.append((doc, start, ids[:room]))
                if len(ids) > room:
                    pieces.append((doc, start + room, ids[room:]))
                room -= len(part[-1][2])
            self._emit(part)

    def _emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids in pieces:
            self.rows.append((doc, start, len(ids), self.number, offset, ids.tobytes()))
            offset += len(ids)
        self.number += 1


PIECE = StructType([
    StructField("start", LongType()), StructField("length", LongType()),
    StructField("doc_tokens", LongType()), StructField("sequence_id", LongType()),
    StructField("offset", LongType()), StructField("ids", BinaryType()),
])


def pack_documents(docs: DataFrame, tokenizer_file: str, text: str = "text",
                   keep: list[str] | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
                   window: int = WINDOW_PIECES) -> DataFrame:
    """Cut documents into pieces and lay these into sequences; one row per piece.

    The columns ``keep`` (default: all but the text) are the document's; then follow ``start``
    (the document's ids before the piece), ``length``, ``doc_tokens``, ``sequence_id``,
    ``offset`` within the sequence and ``ids`` (little-endian unsigned 32-bit).  A document is
    its token ids and ``end_id``.  Whole capacities of a long document are sequences of their
    own.  The remainders wait, and each sequence is filled from the longest one by the multiset
    of remaining lengths that comes closest to the capacity (see :func:`fill`).  A gap that even
    the closest leaves is filled with the beginning of another remainder; what is left at the end
    of a task is cut at powers of two, so that nothing is padded.

    Tasks pack on their own: no shuffle, no hot key, and memory for ``window`` remainders.
    ``tokenizer_file`` must exist on every executor.  A NULL or empty text is ``end_id`` alone.
    Repeated rows are packed one by one; columns named like a result column are replaced.
    """
    names = [f.name for f in PIECE.fields]
    kept = [c for c in docs.columns if c != text] if keep is None else keep
    kept = others(kept, names)
    rows = docs.select(*hidden(kept), F.col(text).alias("_text"))
    fields = rows.drop("_text").schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = WordTokenizer(tokenizer_file)
        packer = Packer(capacity, TaskContext.get().partitionId() << 40)
        schema = None
        for batch in batches:
            own = batch.drop_columns(["_text"])
            schema = own.schema
            values = [column.to_pylist() for column in own.columns]
            at = 0
            for part in slices(batch, text="_text"):
                ids, begins = encoder.ids(texts_of(part, "_text"), end_id)
                for begin, end in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True):
                    packer.add((*(v[at] for v in values), end - begin), ids[begin:end])
                    at += 1
                    if packer.n_waiting >= window:
                        packer.pack(leave=window // 2)
                if packer.rows:
                    yield _batch(packer, schema)
        packer.pack()
        if packer.rows:
            yield _batch(packer, schema)

    def _batch(packer: Packer, schema: pa.Schema) -> pa.RecordBatch:
        rows, packer.rows = packer.rows, []
        columns = [pa.array([r[0][i] for r in rows], field.type) for i, field in enumerate(schema)]
        own = [(r[1], r[2], r[0][-1], r[3], r[4], r[5]) for r in rows]
        columns += [pa.array(values, to_arrow_type(field.dataType))
                    for values, field in zip(zip(*own, strict=True), PIECE.fields, strict=True)]
        return pa.RecordBatch.from_arrays(columns, [*schema.names, *names])

    found = rows.mapInArrow(run, StructType(list(fields.fields) + list(PIECE.fields)))
    return found.select(*shown(kept), *names)
