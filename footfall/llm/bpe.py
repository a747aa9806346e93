"""BPE encoding and decoding by an automaton compiled from the merges.

The automaton's arcs carry tokens, and the paths from its start spell exactly the token sequences
that merging yields.  It begins with one state and an arc for each base symbol.  Each merge
(u, v) adds a gadget: a copy of the state that u leads to, from which v can no longer follow; u
leads to the copy from now on, and wherever u may follow, so may the new token uv, which leads
where v led before.  So every token leads to one state, whatever it comes from, and the arcs out
of a state are all tokens but those that its gadgets took away.

A gadget that takes v away at merge m takes with it what later merges, from m on, make of v as
their left part.  Tokens are numbered in the order of a walk through the tree of left parts, the
latest merges first; then these tokens are one range of numbers, and a state is a sorted list of
ranges.  The 49 thousand merges of a usual vocabulary make some ten thousand different states
and half a million ranges, a few megabytes.
"""

import json
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from footfall.llm.exchange import hidden, others, shown, slices, texts_of
from footfall.llm.lookup import HashIndex, begins, ranges
from footfall.llm.words import words_of

#: Distinct words that a task remembers; beyond, it forgets all and begins anew.
KNOWN_WORDS = 1_000_000
#: Words of more symbols are encoded one by one instead of together.
LONG_WORD = 64

_BYTES = np.arange(256)
_LETTER = ((_BYTES | 32) >= 0x61) & ((_BYTES | 32) <= 0x7A) & (_BYTES < 0x80)
_SIGN = (_BYTES > 0x20) & (_BYTES < 0x7F) & ~_LETTER


@dataclass
class Automaton:
    """``target`` is the state each token leads to, ``place`` its number in the walk.

    ``low`` and ``high`` hold the ranges taken from all states, shifted by the state's number times
    ``span``, after an empty one below them all.  ``arcs`` are the sorted keys (node times ``n_symbols`` plus symbol) of the tree that
    spells tokens by base symbols, ``nodes`` where they lead, ``spelled`` the token spelled at a
    node or -1.
    """

    target: np.ndarray
    place: np.ndarray
    low: np.ndarray
    high: np.ndarray
    span: int
    arcs: np.ndarray
    nodes: np.ndarray
    spelled: np.ndarray
    n_symbols: int

    def may_follow(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        key = state * self.span + self.place[token]
        return self.high[np.searchsorted(self.low, key, side="right") - 1] <= key

    def matches(self, symbols: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All tokens spelled from each position on up to ``last``: where each position's begin,
        their last positions, and the tokens."""
        at = np.arange(len(symbols))
        node = np.zeros(len(symbols), dtype=np.int64)
        found = []
        size = 0
        while len(at):
            key = node * self.n_symbols + symbols[at + size]
            arc = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1)
            there = self.arcs[arc] == key
            at, node = at[there], self.nodes[arc[there]]
            token = self.spelled[node]
            some = token >= 0
            found.append((at[some], at[some] + size, token[some]))
            size += 1
            on = at + size <= last[at]
            at, node = at[on], node[on]
        start, end, token = (np.concatenate(part) for part in zip(*found, strict=True))
        order = np.argsort(start, kind="stable")
        first = np.searchsorted(start[order], np.arange(len(symbols) + 1))
        return first, end[order], token[order]

    def encode(self, symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of words, none of them empty, and where each word's begin.

        ``symbols`` are the base tokens of all words, ``first`` says where each word begins, with an
        entry more for the end.  A prefix of a word has one path only, so each position keeps the
        one token that ends there.
        """
        if not len(symbols):
            return np.empty(0, dtype=np.int64), np.zeros(len(first), dtype=np.int64)
        sizes = np.diff(first)
        begin, end, token = self.matches(symbols, np.repeat(first[1:] - 1, sizes))
        ending = np.full(len(symbols), -1, dtype=np.int64)
        short = np.flatnonzero(sizes <= LONG_WORD)
        short = short[np.argsort(-sizes[short], kind="stable")]
        ascending = -sizes[short]
        for step in range(int(sizes[short].max(initial=0))):
            at = first[short[:np.searchsorted(ascending, -step)]] + step
            state = self.target[ending[at - 1]] if step else np.zeros(len(at), dtype=np.int64)
            n = begin[at + 1] - begin[at]
            which = ranges(begin[at], n)
            ok = which[self.may_follow(np.repeat(state, n), token[which])]
            ending[end[ok]] = token[ok]
        for word in np.flatnonzero(sizes > LONG_WORD).tolist():
            self._walk(int(first[word]), int(first[word + 1]), begin, end, token, ending)
        if (ending < 0).any():
            raise ValueError("the merges leave some words without tokens")
        return self._path(ending, first)

    def _walk(self, start: int, stop: int, begin: np.ndarray, end: np.ndarray, token: np.ndarray,
              ending: np.ndarray) -> None:
        """One long word, position by position."""
        for at in range(start, stop):
            state = self.target[ending[at - 1]] if at > start else 0
            which = slice(begin[at], begin[at + 1])
            ok = self.may_follow(state, token[which])
            ending[end[which][ok]] = token[which][ok]

    def _path(self, ending: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        on = np.zeros(len(ending), dtype=bool)
        length = self.lengths[ending]
        at, stop = first[1:] - 1, first[:-1]
        while len(at):
            on[at] = True
            at = at - length[at]
            more = at >= stop
            at, stop = at[more], stop[more]
        return ending[on], np.concatenate(([0], np.cumsum(on)))[first]

    @property
    def lengths(self) -> np.ndarray:
        """Base symbols of each token."""
        if not hasattr(self, "_lengths"):
            depth = np.zeros(len(self.spelled), dtype=np.int64)
            for level in np.argsort(self.nodes).tolist():  # a node's number is above its parent's
                depth[self.nodes[level]] = depth[self.arcs[level] // self.n_symbols] + 1
            self._lengths = np.zeros(len(self.target), dtype=np.int64)
            some = self.spelled >= 0
            self._lengths[self.spelled[some]] = depth[some]
        return self._lengths


def compile_merges(n_tokens: int, merges: list[tuple[int, int, int]]) -> Automaton:
    """The automaton of merges (left, right, result), the first one first, over tokens below
    ``n_tokens``; tokens that no merge makes are base symbols.

    Every merge has to make a token of its own from base symbols and results of earlier merges, as
    in a trained vocabulary; otherwise ValueError.  A merge that earlier ones leave nothing to do
    adds no gadget, and what it would make is never used.
    """
    rank = {made: m for m, (_, _, made) in enumerate(merges)}
    if len(rank) < len(merges):
        raise ValueError("two merges make the same token")
    if any(rank.get(part, -1) >= m for m, merge in enumerate(merges) for part in merge[:2]):
        raise ValueError("a merge uses a token that only a later one makes")
    place, stop, later = _walk_left_parts(n_tokens, merges)
    target = [0] * n_tokens
    base, taken = [-1], [(0, 0)]
    live = np.ones(n_tokens, dtype=bool)
    for m, (u, v, made) in enumerate(merges):
        state, at = target[u], place[v]
        while state and not taken[state][0] <= at < taken[state][1]:
            state = base[state]
        if state or not (live[u] and live[v]):
            live[made] = False
            continue
        k = bisect_right(later[v], -m) if v in later else 0
        base.append(target[u])
        taken.append((at, stop[v][k]))
        target[u], target[made] = len(base) - 1, target[v]
    used = sorted({0, *target})
    low, high = [-1], [-1]
    for number, state in enumerate(used):
        for begin, end in _ranges_of(state, base, taken):
            low.append(number * n_tokens + begin)
            high.append(number * n_tokens + end)
    arcs, nodes, spelled = _spelling(n_tokens, merges, live)
    return Automaton(np.searchsorted(used, target), np.array(place), np.array(low, dtype=np.int64),
                     np.array(high, dtype=np.int64), n_tokens, arcs, nodes, spelled, n_tokens)


def _walk_left_parts(n_tokens: int, merges: list[tuple[int, int, int]]
                     ) -> tuple[list[int], list[list[int]], dict[int, list[int]]]:
    """Each token's place in the walk; for each token the end of the range it makes with its k latest
    extensions; and their merges, negative, so that they ascend."""
    extended: dict[int, list[int]] = {}
    later: dict[int, list[int]] = {}
    for m in range(len(merges) - 1, -1, -1):
        left, _, made = merges[m]
        extended.setdefault(left, []).append(made)
        later.setdefault(left, []).append(-m)
    made_by_merge = {made for _, _, made in merges}
    walk, place = [], [0] * n_tokens
    waiting = [t for t in range(n_tokens - 1, -1, -1) if t not in made_by_merge]
    while waiting:
        token = waiting.pop()
        place[token] = len(walk)
        walk.append(token)
        waiting.extend(reversed(extended.get(token, [])))
    stop: list[list[int]] = [[]] * n_tokens
    for token in reversed(walk):
        ends = [place[token] + 1]
        for child in extended.get(token, []):
            ends.append(stop[child][-1])
        stop[token] = ends
    return place, stop, later


def _ranges_of(state: int, base: list[int], taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The ranges that the gadgets of a state took away, joined where they overlap."""
    found = []
    while state:
        found.append(taken[state])
        state = base[state]
    out: list[tuple[int, int]] = []
    for begin, end in sorted(found):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def _spelling(n_tokens: int, merges: list[tuple[int, int, int]], live: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tree that spells the live tokens by base symbols."""
    parts: dict[int, tuple[int, ...]] = {}
    for u, v, made in merges:
        parts[made] = parts.get(u, (u,)) + parts.get(v, (v,))
    children: dict[int, int] = {}
    spelled = [-1]
    for token in range(n_tokens):
        node = 0
        if live[token]:
            for symbol in parts.get(token, (token,)):
                key = node * n_tokens + symbol
                if key not in children:
                    children[key] = len(spelled)
                    spelled.append(-1)
                node = children[key]
            if spelled[node] >= 0:
                raise ValueError("two merges make the same token")
            spelled[node] = token
    arcs = np.array(sorted(children), dtype=np.int64)
    return arcs, np.array([children[a] for a in arcs.tolist()], dtype=np.int64), np.array(spelled)


@dataclass
class CompiledTokenizer:
    """What tasks need of a tokenizer's file: the automaton, base symbols, special tokens, labels, and
    the settings that split a text into words."""

    automaton: Automaton
    inner: dict[str, int]
    final: dict[str, int]
    special: dict[str, int]
    labels: bytes
    label_begin: np.ndarray
    settings: str


def compile_tokenizer(file: str) -> CompiledTokenizer:
    """Compile the file of a BPE tokenizer that drops blanks, splits at them, maps bytes to letters
    and joins labels by blanks when decoding; ValueError for settings that this module lacks."""
    with open(file, encoding="utf-8") as source:
        whole = json.load(source)
    model, added = whole["model"], whole["added_tokens"]
    vocabulary: dict[str, int] = model["vocab"]
    if model["type"] != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix"):
        raise ValueError("not a plain BPE model")
    if whole["decoder"] is not None or any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("the tokenizer has a decoder or special tokens with conditions")
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    numbered = [(vocabulary[u], vocabulary[v], vocabulary[u + v]) for u, v in merges]
    n_tokens = max([*vocabulary.values(), *(t["id"] for t in added)]) + 1
    made = {m[2] for m in numbered}
    suffix = model.get("end_of_word_suffix") or ""
    symbols = {t: i for t, i in vocabulary.items() if i not in made}
    final = {t.removesuffix(suffix): i for t, i in symbols.items() if t.endswith(suffix)}
    inner = {t: i for t, i in symbols.items() if not suffix or not t.endswith(suffix)}
    texts = {i: t for t, i in vocabulary.items()} | {t["id"]: t["content"] for t in added}
    labels = [texts[i].encode() + b" " if i in texts else b"" for i in range(n_tokens)]
    settings = {**whole, "model": {"type": "BPE", "vocab": {}, "merges": []}, "added_tokens": [],
                "truncation": None, "padding": None}
    return CompiledTokenizer(
        compile_merges(n_tokens, numbered), inner, final, {t["content"]: t["id"] for t in added},
        b"".join(labels), begins(np.array([len(t) for t in labels])), json.dumps(settings))


class WordEncoder:
    """Token ids of texts; every distinct word between blanks goes through the automaton once."""

    def __init__(self, compiled: CompiledTokenizer) -> None:
        from tokenizers import Tokenizer

        splitter = Tokenizer.from_str(compiled.settings)
        self.normalizer, self.splitter = splitter.normalizer, splitter.pre_tokenizer
        self.compiled = compiled
        self.lower = self._normal("AZ") == "az"
        special = sorted(compiled.special, key=len, reverse=True)
        self.special = re.compile(b"|".join(re.escape(t.encode()) for t in special)) if special else None
        self._forget()

    def _forget(self) -> None:
        self.index = HashIndex()
        self.flat = np.empty(0, dtype=np.uint32)
        self.place = np.empty(0, dtype=np.int64)
        self.size = np.empty(0, dtype=np.int64)

    def _normal(self, text: str) -> str:
        return self.normalizer.normalize_str(text) if self.normalizer else text

    def _split(self, words: list[bytes]) -> tuple[list[str], np.ndarray]:
        """The pieces the tokenizer makes of words, and where each word's begin.

        All words are split in one call; where the normalizer makes blanks inside a word, one by one.
        """
        texts = [word.decode() for word in words]
        joint = self._normal(" ".join(texts))
        starts = begins(np.array([len(text) + 1 for text in joint.split(" ")], dtype=np.int64))
        if len(starts) == len(texts) + 1:
            found = self.splitter.pre_tokenize_str(joint)
            at = np.array([span[0] for _, span in found], dtype=np.int64)
            return [piece for piece, _ in found], np.searchsorted(at, starts)
        own = [[p for p, _ in self.splitter.pre_tokenize_str(self._normal(t)) if p] for t in texts]
        return [p for pieces in own for p in pieces], begins(np.array([len(p) for p in own]))

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> np.ndarray:
        inner, final = self.compiled.inner, self.compiled.final
        flat, word_first = self._split(words)
        symbols = []
        for piece in flat:
            symbols += [inner[s] for s in piece[:-1]]
            symbols.append(final[piece[-1]])
        tokens, first = self.compiled.automaton.encode(
            np.array(symbols, dtype=np.int64), begins(np.array([len(p) for p in flat], dtype=np.int64)))
        of_word = first[word_first]
        self.place = np.concatenate((self.place, of_word[:-1] + len(self.flat)))
        self.size = np.concatenate((self.size, np.diff(of_word)))
        self.flat = np.concatenate((self.flat, tokens.astype(np.uint32)))
        return self.index.add(hashes)

    def _parts(self, texts: list[bytes | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Texts cut at special tokens: the parts, the id after each (-1: none), and where each text's
        parts begin."""
        parts, after, first = [], [], [0]
        for text in texts:
            at = 0
            for found in self.special.finditer(text or b"") if self.special else ():
                parts.append(text[at:found.start()])
                after.append(self.compiled.special[found[0].decode()])
                at = found.end()
            parts.append((text or b"")[at:])
            after.append(-1)
            first.append(len(parts))
        return parts, np.array(after, dtype=np.int64), np.array(first)

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) and where each text's begin."""
        parts, after, first = self._parts(texts)
        words = words_of(parts, lower=self.lower, cut=(_LETTER, _SIGN))
        if len(self.index) > KNOWN_WORDS:
            self._forget()
        at = self.index.find(words.hashes)
        new = np.flatnonzero(at < 0)
        if len(new):
            hashes, one, which = np.unique(words.hashes[new], return_index=True, return_inverse=True)
            at[new] = self._learn(hashes, [words.word(i) for i in new[one].tolist()])[which]
        size = self.size[at]
        ids = self.flat[ranges(self.place[at], size)]
        own = begins(size)[words.first]
        closed = begins(np.diff(own) + (after >= 0))
        out = np.empty(int(closed[-1]), dtype="<u4")
        out[ranges(closed[:-1], np.diff(own))] = ids
        out[closed[1:][after >= 0] - 1] = after[after >= 0]
        return out, closed[first]


def _label_text(compiled: CompiledTokenizer, ids: np.ndarray, first: np.ndarray) -> list[str]:
    """The labels of each text's ids, joined by blanks; ids without a label are left out."""
    n_tokens = len(compiled.label_begin) - 1
    size = np.zeros(len(ids), dtype=np.int64)
    known = ids < n_tokens
    at = ids[known].astype(np.int64)
    size[known] = np.diff(compiled.label_begin)[at]
    place = np.zeros(len(ids), dtype=np.int64)
    place[known] = compiled.label_begin[at]
    raw = np.frombuffer(compiled.labels, dtype=np.uint8)[ranges(place, size)].tobytes()
    cuts = begins(size)[first].tolist()
    return [raw[a:max(a, b - 1)].decode() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def encode_documents(docs: DataFrame, tokenizer_file: str, text: str = "text",
                     keep: list[str] | None = None) -> DataFrame:
    """``n_tokens`` and ``ids`` (little-endian unsigned 32-bit) of every whole text, as the tokenizer
    of ``tokenizer_file`` gives them without added special tokens, truncation and padding.

    The columns ``keep`` (default: all but the text) come first; those named like a result column
    are replaced.  Special tokens that a text spells out are one id each.  A NULL or empty text and
    one of blanks has no ids.  Repeated rows are encoded one by one; an empty table gives an empty
    result.  Only the driver reads the file; tasks get the compiled tables, whose size the
    vocabulary bounds.  No shuffle; a task works on a megabyte of texts, or one longer text, at once.
    """
    result = StructType([StructField("n_tokens", LongType()), StructField("ids", BinaryType())])
    kept = _kept(docs, text, keep, result.names)
    shared = docs.sparkSession.sparkContext.broadcast(compile_tokenizer(tokenizer_file))
    rows = docs.select(*hidden(kept), F.col(f"`{text}`").alias("_text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(shared.value)
        for batch in batches:
            for part in slices(batch, text="_text"):
                ids, first = encoder.encode(texts_of(part, "_text"))
                raw, cuts = ids.tobytes(), (4 * first).tolist()
                own = [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield _with(part.drop_columns(["_text"]), result.names,
                            [pa.array(np.diff(first)), pa.array(own, pa.binary())])

    found = rows.mapInArrow(run, StructType(rows.drop("_text").schema.fields + result.fields))
    return found.select(*shown(kept), *result.names)


def decode_documents(encoded: DataFrame, tokenizer_file: str, ids: str = "ids",
                     keep: list[str] | None = None) -> DataFrame:
    """``decoded``: the labels that the automaton's path of ``ids`` emits, joined by blanks.

    Special tokens are labels too.  NULL stands for no ids, and no ids give an empty text; ids
    beyond the vocabulary emit nothing.  The columns ``keep`` (default: all) come first; one named
    ``decoded`` is replaced.
    """
    kept = _kept(encoded, None, keep, ["decoded"])
    shared = encoded.sparkSession.sparkContext.broadcast(compile_tokenizer(tokenizer_file))
    rows = encoded.select(*hidden(kept), F.col(f"`{ids}`").alias("_ids"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = shared.value
        for batch in batches:
            for part in slices(batch, text="_ids"):
                own = [value or b"" for value in part["_ids"].to_pylist()]
                flat = np.frombuffer(b"".join(own), dtype="<u4")
                first = begins(np.array([len(value) // 4 for value in own], dtype=np.int64))
                yield _with(part.drop_columns(["_ids"]), ["decoded"],
                            [pa.array(_label_text(compiled, flat, first), pa.string())])

    schema = StructType(rows.drop("_ids").schema.fields + [StructField("decoded", StringType())])
    return rows.mapInArrow(run, schema).select(*shown(kept), "decoded")


def _kept(df: DataFrame, used: str | None, keep: list[str] | None, names: list[str]) -> list[str]:
    """The columns to hand on."""
    kept = [c for c in df.columns if c != used] if keep is None else keep
    return others(kept, names)


def _with(part: pa.RecordBatch, names: list[str], columns: list[pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*part.columns, *columns], [*part.schema.names, *names])
