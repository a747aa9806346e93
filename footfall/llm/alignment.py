"""Alignment of two tokenizers' tokens of the same texts.

The tokens of a byte-level BPE (A) and of a sentencepiece model (B) are laid over the bytes of a
blank and the text.  Where tokens of both end, the text is cut; an A and a B token within the same
cuts are linked.  How often ids are linked across the corpus says which B ids an A id stands for.

Texts are cut at blanks where neither tokenizer has a token across the cut, and a task tokenizes
each distinct segment once.  Spans come from the tokenizers: character offsets of A, byte
spans of B's proto.  These are coarse: tokens that share one character, or are bytes of one, have
the same span or an empty one, and there the lengths of their decoded bytes cut on.
"""

import hashlib
import os
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
from pyspark.sql.types import LongType, StringType, StructField, StructType

from footfall.llm.exchange import (
    answered_rows, hidden, numbers, others, packed, release, shown, slices, texts_of,
    write_blobs,
)
from footfall.llm.lookup import HashIndex, begins, ranges
from footfall.llm.words import _word_hashes

#: Bytes of texts that one chunk holds; a longer text is a chunk of its own.
CHUNK_BYTES = 2 << 20
#: Distinct segments that a task remembers; beyond, it forgets all and begins anew.
KNOWN_SEGMENTS = 400_000
#: Bytes of segments that the tokenizers take at a time.
LEARN_BYTES = 1 << 19
#: Segments that the tokenizers take as one text, where they may.
TOGETHER = 64
#: A pair of ids as one number: the A id times this, plus the B id.
PAIR = 1 << 32
SPACE_MARK = "▁"
#: What follows an id of a group's text: another of its side, the other side, the next group.
MARKS = (b",", b"|", b";")


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: a visible Latin-1 character stands
    for itself, the others follow from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden_bytes = [b for b in range(256) if b not in set(visible)]
    return ({chr(b): b for b in visible}
            | {chr(0x100 + i): b for i, b in enumerate(hidden_bytes)})


@dataclass
class Tokens:
    """Tokens of segments, flat: their ids, where their bytes end in the joined segments, and the number
    of the segment they belong to."""

    ids: np.ndarray
    ends: np.ndarray
    segment: np.ndarray


class Labels:
    """Decoded bytes of all ids of a vocabulary."""

    def __init__(self, labels: list[bytes]) -> None:
        self.raw = np.frombuffer(b"".join(labels), dtype=np.uint8)
        self.first = begins(np.array([len(label) for label in labels], dtype=np.int64))
        self.size = np.diff(self.first)

    def join(self, ids: np.ndarray) -> np.ndarray:
        return self.raw[ranges(self.first[ids], self.size[ids])]


class TokenizerPair:
    """Both tokenizers of a task, and their tokens' bytes."""

    def __init__(self, file_a: str, file_b: str) -> None:
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(file_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=file_b)
        letters = byte_letters()
        names = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        special = self.a.get_added_tokens_decoder()
        self.labels_a = Labels([
            names[i].encode() if i in special else bytes(letters[c] for c in names[i])
            if i in names else b"" for i in range(max(names) + 1)])
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.labels_b = Labels([
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode()
            for i, p in enumerate(pieces)])
        self.decimals = Labels([b"%d%s" % (i, mark) for i in range(max(max(names) + 1, len(pieces)))
                                for mark in MARKS])
        self.may_cut = not any(x != SPACE_MARK and y == SPACE_MARK
                               for p in pieces for x, y in zip(p, p[1:], strict=False))

    def tokens_a(self, segments: list[str], raw: np.ndarray, first: np.ndarray, together: int) -> Tokens:
        """Character offsets, as bytes, refined; so many segments are one text for the tokenizer."""
        found = self.a.encode_batch(_joined(segments, together), add_special_tokens=False)
        sizes = [len(e) for e in found]
        ids = np.array([i for e in found for i in e.ids], dtype=np.int64)
        spans = np.array([x for e in found for s in e.offsets for x in s], dtype=np.int64)
        lead = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))  # where characters begin
        base = np.repeat(np.searchsorted(lead, first[:-1:together]), sizes)
        place = lead[spans.reshape(-1, 2) + base[:, None]]
        return refined(ids, place[:, 0], place[:, 1], _owner(place[:, 0], first), first, self.labels_a)

    def tokens_b(self, segments: list[str], first: np.ndarray, together: int) -> Tokens:
        """Byte spans of the protos, refined; the blank that a text begins with is B's own."""
        found = [e.pieces for e in self.b.encode(
            [text[1:] for text in _joined(segments, together)], return_type="proto")]
        sizes = np.array([len(e) for e in found], dtype=np.int64)
        pieces = [p for e in found for p in e]
        ids, begin, end = (np.array(v, dtype=np.int64) for v in (
            [p.id for p in pieces], [p.begin for p in pieces], [p.end for p in pieces]))
        base = np.repeat(first[:-1:together], sizes) + 1
        begin, end = begin + base, end + base
        begin[begins(sizes)[:-1][sizes > 0]] -= 1
        return refined(ids, begin, end, _owner(begin, first), first, self.labels_b)


def _joined(segments: list[str], together: int) -> list[str]:
    return ["".join(segments[at:at + together]) for at in range(0, len(segments), together)]


def _owner(begin: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The segment in which each token begins."""
    return np.minimum(np.searchsorted(first, begin, side="right"), len(first) - 1) - 1


def refined(ids: np.ndarray, begin: np.ndarray, end: np.ndarray, segment: np.ndarray,
            first: np.ndarray, labels: Labels) -> Tokens:
    """Tokens with exact ends, from coarse spans.

    A token whose span is not empty and shares no byte with its neighbours' ends where its span
    does.  The others are parts of characters: from the last sure end on (or the segment's
    beginning) each has the length of its decoded bytes.
    """
    if not len(ids):
        return Tokens(ids, end, segment)
    same = segment[1:] == segment[:-1]
    apart = ~same | (end[:-1] <= begin[1:])
    sure = (end > begin) & np.append(apart, True) & np.append(True, apart)
    decoded = np.cumsum(labels.size[ids])
    opening = np.flatnonzero(np.append(True, ~same))
    start = np.repeat(opening, np.diff(np.append(opening, len(ids))))
    last = np.maximum.accumulate(np.where(sure, np.arange(len(ids)), -1))
    known = last >= start
    before = np.where(start > 0, decoded[start - 1], 0)
    ends = np.where(known, end[last] + decoded - decoded[last], first[segment] + decoded - before)
    return Tokens(ids, ends, segment)


def exact(tokens: Tokens, raw: np.ndarray, first: np.ndarray, labels: Labels) -> np.ndarray:
    """Whether the tokens' joined bytes are those of each segment, token by token."""
    size = labels.size[tokens.ids]
    start = np.append(0, tokens.ends[:-1])
    opening = np.append(True, tokens.segment[1:] != tokens.segment[:-1])[:len(start)]
    start = np.where(opening, first[tokens.segment], start)
    right = size == tokens.ends - start
    joined = np.bincount(tokens.segment, size, len(first) - 1).astype(np.int64) == np.diff(first)
    equal = np.ones(len(first) - 1, dtype=bool)
    equal[tokens.segment[~right]] = False
    equal &= joined
    if equal.all():
        chosen, at = tokens.ids, ranges(first[:-1], np.diff(first))
    else:
        chosen = tokens.ids[equal[tokens.segment]]
        at = ranges(first[:-1][equal], np.diff(first)[equal])
    differs = np.flatnonzero(labels.join(chosen) != raw[at])
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    equal[owner[at[differs]]] = False
    return equal


class Segments:
    """What a task knows of the segments it has met: numbers of tokens and groups, the groups as text,
    and the linked pairs of ids with how often each is linked."""

    def __init__(self, pair: TokenizerPair) -> None:
        self.pair = pair
        self.forget()

    def forget(self) -> None:
        self.index = HashIndex()
        self.right = np.empty(0, dtype=bool)
        self.counts = np.empty((0, 4), dtype=np.int64)
        self.text_place, self.text_size, self.text = (np.empty(0, dtype=t) for t in (np.int64, np.int64, np.uint8))
        self.place, self.size, self.pairs, self.times = (np.empty(0, dtype=np.int64) for _ in range(4))

    def learn(self, hashes: np.ndarray, segments: list[bytes], together: int) -> np.ndarray:
        """Tokenize distinct segments, each beginning with a blank; the numbers of their entries.

        Where they end so that no token reaches from one into the next, the tokenizers may take some
        ``together`` as one text.
        """
        ends = np.cumsum([len(s) for s in segments])
        numbers, at = [], 0
        while at < len(segments):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + LEARN_BYTES, side="right")))
            numbers.append(self._learn(hashes[at:to], segments[at:to], together))
            at = to
        return np.concatenate(numbers) if numbers else np.empty(0, dtype=np.int64)

    def _learn(self, hashes: np.ndarray, segments: list[bytes], together: int) -> np.ndarray:
        raw = np.frombuffer(b"".join(segments), dtype=np.uint8)
        first = begins(np.array([len(s) for s in segments], dtype=np.int64))
        texts = [s.decode() for s in segments]
        a = self.pair.tokens_a(texts, raw, first, together)
        b = self.pair.tokens_b(texts, first, together)
        right = exact(a, raw, first, self.pair.labels_a) & exact(b, raw, first, self.pair.labels_b)
        in_a, in_b = right[a.segment], right[b.segment]
        a = Tokens(a.ids[in_a], a.ends[in_a], a.segment[in_a])
        b = Tokens(b.ids[in_b], b.ends[in_b], b.segment[in_b])
        n = len(segments)
        cuts = np.intersect1d(a.ends, b.ends, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, a.ends), np.searchsorted(cuts, b.ends)
        of_group = np.searchsorted(first, cuts) - 1
        pairs, times, group = _products(group_a, a.ids, group_b, b.ids, len(cuts))
        links = np.bincount(group_a, minlength=len(cuts)) * np.bincount(group_b, minlength=len(cuts))
        counts = np.stack([
            np.bincount(a.segment, minlength=n), np.bincount(b.segment, minlength=n),
            np.bincount(of_group, minlength=n),
            np.bincount(of_group, links, n)], axis=1).astype(np.int64)
        size = np.bincount(of_group[group], minlength=n)
        self.place = np.concatenate((self.place, begins(size)[:-1] + len(self.pairs)))
        self.size = np.concatenate((self.size, size))
        self.pairs = np.concatenate((self.pairs, pairs))
        self.times = np.concatenate((self.times, times))
        self.right = np.concatenate((self.right, right))
        self.counts = np.concatenate((self.counts, counts))
        text, size = _group_texts(group_a, a, group_b, b, n, self.pair.decimals)
        self.text_place = np.concatenate((self.text_place, begins(size)[:-1] + len(self.text)))
        self.text_size = np.concatenate((self.text_size, size))
        self.text = np.concatenate((self.text, text))
        return self.index.add(hashes)


def _products(group_a: np.ndarray, ids_a: np.ndarray, group_b: np.ndarray, ids_b: np.ndarray,
              n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of ids of each group, how often each occurs, and their groups.

    Equal ids of a group count together first, so a group of many tokens does not give their
    product.
    """
    both = []
    for group, ids in ((group_a, ids_a), (group_b, ids_b)):
        keys, times = np.unique(group * PAIR + ids, return_counts=True)
        group, ids = keys // PAIR, keys % PAIR
        both.append((group, ids, times, np.searchsorted(group, np.arange(n + 1))))
    (of_a, a, times_a, _), (_, b, times_b, first_b) = both
    partners = np.diff(first_b)[of_a]
    at_b = ranges(first_b[:-1][of_a], partners)
    return (np.repeat(a * PAIR, partners) + b[at_b], np.repeat(times_a, partners) * times_b[at_b],
            np.repeat(of_a, partners))


def _group_texts(group_a: np.ndarray, a: Tokens, group_b: np.ndarray, b: Tokens, n: int,
                 decimals: Labels) -> tuple[np.ndarray, np.ndarray]:
    """The segments' groups as ``a1,a2|b1;``, joined, and the size of each one's."""
    side = np.repeat((0, 1), (len(group_a), len(group_b)))
    key = np.concatenate((group_a, group_b)) * 2 + side
    order = np.argsort(key, kind="stable")
    key, ids = key[order], np.concatenate((a.ids, b.ids))[order]
    segment = np.concatenate((a.segment, b.segment))[order]
    following = np.append(key[1:], -1)[:len(key)]
    mark = np.where(following == key, 0, np.where(key % 2 == 0, 1, 2))
    items = ids * len(MARKS) + mark
    return decimals.join(items), np.bincount(segment, decimals.size[items], n).astype(np.int64)


def _solid(raw: np.ndarray) -> np.ndarray:
    """Bytes that surely end no white space: a visible ASCII character, or the last byte of a character
    of which the lead byte tells that."""
    ascii_ = (raw >= 0x21) & (raw <= 0x7E)
    inside = (raw & 0xC0) == 0x80
    solid = ascii_.copy()
    solid[1:] |= inside[1:] & (raw[:-1] >= 0xC3) & (raw[:-1] <= 0xDF)
    solid[2:] |= inside[2:] & inside[1:-1] & (raw[:-2] >= 0xE4) & (raw[:-2] <= 0xEF)
    solid[3:] |= inside[3:] & (raw[:-3] >= 0xF0) & (raw[:-3] <= 0xF4)
    return solid


@dataclass
class Aligned:
    """A chunk's documents: ``counts`` has a row of numbers of A tokens, B tokens, groups and links;
    ``digests`` the groups' hash; document d has the pairs ``pairs[which[first[d]:first[d + 1]]]``,
    linked ``times`` as often."""

    counts: np.ndarray
    digests: list[str]
    pairs: np.ndarray
    which: np.ndarray
    times: np.ndarray
    first: np.ndarray


def align(texts: list[bytes | None], known: Segments) -> Aligned:
    """Align the tokens of texts; one that is empty, NULL or not spelled exactly has none."""
    if len(known.index) > KNOWN_SEGMENTS:
        known.forget()
    spaced = [b" " + text if text else b"" for text in texts]
    raw = np.frombuffer(b"".join(spaced), dtype=np.uint8)
    first = begins(np.array([len(t) for t in spaced], dtype=np.int64))
    solid = _solid(raw) if known.pair.may_cut else np.zeros(len(raw), dtype=bool)
    begin = np.zeros(len(raw) + 1, dtype=bool)
    begin[1:-1] = solid[:-1] & (raw[1:] == 0x20)
    begin[first[1:] - 1] = False  # B spells no single blank on its own
    begin[first[:-1][np.diff(first) > 0]] = True
    start = np.flatnonzero(begin)
    entry, text_of = _entries(raw, start, np.append(start[1:], len(raw))[:len(start)], first, known, solid)
    wrong = np.unique(text_of[~known.right[entry]])
    if len(wrong):  # whole, as cuts are sure only where tokens spell the text
        keep = ~np.isin(text_of, wrong)
        again, owner = _entries(raw, first[wrong], first[wrong + 1], np.append(first[wrong], len(raw)), known)
        entry = np.concatenate((entry[keep], again[known.right[again]]))
        text_of = np.concatenate((text_of[keep], wrong[owner[known.right[again]]]))
        order = np.argsort(text_of, kind="stable")
        entry, text_of = entry[order], text_of[order]
    n = len(texts)
    counts = np.zeros((n, 4), dtype=np.int64)
    np.add.at(counts, text_of, known.counts[entry])
    size = known.text_size[entry]
    groups = memoryview(known.text[ranges(known.text_place[entry], size)])
    cut = begins(size)[np.searchsorted(text_of, np.arange(n + 1))].tolist()
    digests = [hashlib.sha256(groups[x:y - 1]).hexdigest() if y > x else ""
               for x, y in zip(cut[:-1], cut[1:], strict=True)]
    return Aligned(counts, digests, *_document_pairs(text_of, entry, n, known))


def _entries(raw: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray, known: Segments,
             solid: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The entries of segments, and the text of each."""
    hashes = _word_hashes(raw, start, end)
    at = known.index.find(hashes)
    new = np.flatnonzero(at < 0)
    if len(new):
        distinct, one, which = np.unique(hashes[new], return_index=True, return_inverse=True)
        one = new[one]
        together = solid[end[one] - 1] if solid is not None else np.zeros(len(one), dtype=bool)
        numbers = np.empty(len(one), dtype=np.int64)
        for kind in (True, False):
            own = np.flatnonzero(together == kind)
            numbers[own] = known.learn(distinct[own], [raw[x:y].tobytes() for x, y in zip(
                start[one[own]].tolist(), end[one[own]].tolist(), strict=True)], TOGETHER if kind else 1)
        at[new] = numbers[which]
    return at, np.searchsorted(first, start, side="right") - 1


def _document_pairs(text_of: np.ndarray, entry: np.ndarray, n: int, known: Segments
                    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of all texts, and of each text which ones and how often."""
    keys, repeats = np.unique(text_of * (len(known.size) + 1) + entry, return_counts=True)
    text_of, entry = keys // (len(known.size) + 1), keys % (len(known.size) + 1)
    size = known.size[entry]
    at = ranges(known.place[entry], size)
    pairs, which = np.unique(known.pairs[at], return_inverse=True)
    key = np.repeat(text_of, size) * (len(pairs) + 1) + which
    times = known.times[at] * np.repeat(repeats, size)
    order = np.argsort(key, kind="stable")
    key, times = key[order], times[order]
    begin = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
    times = np.add.reduceat(times, begin) if len(begin) else times
    key = key[begin]
    first = np.searchsorted(key // (len(pairs) + 1), np.arange(n + 1))
    return pairs, key % (len(pairs) + 1), times, first


COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
RESULT = StructType([StructField(name, LongType()) for name in COUNTS]
                    + [StructField("groups_sha256", StringType())])


def align_documents(docs: DataFrame, file_a: str, file_b: str, text: str = "text",
                    keep: list[str] | None = None) -> DataFrame:
    """Align the tokens of every whole text by a byte-level BPE file (A) and a sentencepiece model (B).

    After the columns ``keep`` (default: all but the text; those named like a result column are
    replaced) follow the numbers of A tokens, B tokens, groups and links, ``n_best`` (links whose
    pair is linked in as many documents as any pair of its A id), ``count_sum`` (over links, the
    documents that hold the pair linked), and ``groups_sha256`` of the groups as
    ``a1,a2|b1;a3|b2,b3``.

    A text that is NULL or empty, or that the joined bytes of A's or B's tokens do not spell, has
    zeros and an empty hash.  Repeated rows are documents of their own.  Ties: all pairs of an A
    id with the highest count are best.

    Tokenized once: tasks write numbered chunks of results, so a lost executor changes nothing.
    Each chunk asks once for each of its distinct pairs; a pair that every document holds is one
    row per chunk.  The counts come back by chunk; nothing is broadcast or collected.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c != text] if keep is None else keep
    kept = others(kept, RESULT.names)
    chunks = write_blobs(
        _aligned_chunks(docs.select(*hidden(kept), F.col(f"`{text}`").alias("_text")), file_a, file_b),
        "alignment", compression="uncompressed")
    counts = pair_counts(chunks)
    answers = _asked(chunks).select("chunk", "pair").join(counts, "pair").select(
        "chunk", "pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    own = docs.select(*hidden(kept)).schema

    def finish(chunk: int, rows: pa.RecordBatch, answers: pa.Table) -> dict:
        order = np.argsort(answers["pair"].to_numpy())
        count = answers["count"].to_numpy()[order]
        best = answers["best"].to_numpy(zero_copy_only=False)[order]
        which = rows["_which"].flatten().to_numpy()
        times = rows["_times"].flatten().to_numpy()
        first = np.asarray(rows["_which"].offsets)
        first = first - first[0]

        def totals(values: np.ndarray) -> np.ndarray:
            return np.diff(begins(values)[first])

        found = {f"_k{i}": rows[f"_k{i}"] for i in range(len(kept))}
        found |= {name: rows[name] for name in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
        return found | {"n_best": totals(times * best[which]), "count_sum": totals(times * count[which])}

    result = StructType(own.fields + RESULT.fields)
    out = answered_rows(chunks, answers, finish, result)
    release(spark)
    return out.select(*shown(kept), *RESULT.names)


def _aligned_chunks(rows: DataFrame, file_a: str, file_b: str) -> DataFrame:
    """Numbered chunks: documents with their results (``data``), the chunk's distinct pairs, and in how
    many of its documents each is linked."""
    schema = StructType([*rows.drop("_text").schema.fields, *[f for f in RESULT.fields if f.name not in (
        "n_best", "count_sum")]])
    plain = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        # a task has one core; more threads of the library would take those of other tasks
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        known = Segments(TokenizerPair(file_a, file_b))
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, text="_text", limit=CHUNK_BYTES):
                found = align(texts_of(part, "_text"), known)
                own = part.drop_columns(["_text"])
                offsets = pa.array(found.first, pa.int64())
                columns = [*own.columns, *(pa.array(found.counts[:, i]) for i in range(4)),
                           pa.array(found.digests, pa.string()),
                           pa.LargeListArray.from_arrays(offsets, pa.array(found.which.astype(np.uint32))),
                           pa.LargeListArray.from_arrays(offsets, pa.array(found.times))]
                data = packed(pa.RecordBatch.from_arrays(columns, [*plain.names, "_which", "_times"]))
                holders = np.bincount(found.which, minlength=len(found.pairs))
                yield pa.RecordBatch.from_pydict({
                    "chunk": [number], "data": pa.array([data], pa.binary()),
                    "pairs": pa.array([found.pairs.astype("<i8").tobytes()], pa.binary()),
                    "holders": pa.array([holders.astype("<i8").tobytes()], pa.binary())})
                number += 1

    return rows.mapInArrow(run, "chunk long, data binary, pairs binary, holders binary")


def _asked(chunks: DataFrame) -> DataFrame:
    """A row for each distinct pair of a chunk: how many of its documents hold it linked."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, pairs, holders in zip(*(batch[c] for c in ("chunk", "pairs", "holders")), strict=True):
                pair = numbers(pairs, "<i8")
                yield pa.RecordBatch.from_pydict({
                    "chunk": np.full(len(pair), chunk.as_py()), "pair": pair, "n": numbers(holders, "<i8")})

    return chunks.select("chunk", "pairs", "holders").mapInArrow(run, "chunk long, pair long, n long")


def pair_counts(chunks: DataFrame) -> DataFrame:
    """For each pair of ids, in how many documents it is linked (``count``), and the most of any pair
    of its A id (``highest``)."""
    a: Column = F.shiftright("pair", 32)
    counts = _asked(chunks).groupBy("pair").agg(F.sum("n").alias("count"))
    return counts.withColumn("highest", F.max("count").over(Window.partitionBy(a)))
