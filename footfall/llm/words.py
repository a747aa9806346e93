"""Words of whole texts as NumPy arrays, for use inside Spark tasks.

A batch of texts becomes one buffer of UTF-8 bytes with the byte range and a 64-bit hash of
every word, so that windows of words can be hashed and compared without a Python loop.
"""

from dataclasses import dataclass

import numpy as np

#: Odd factors of the two polynomial hashes, and of the mixing step after them.
BYTE_FACTOR = 0xD6E8FEB86659FD93
WORD_FACTOR = 0xA0761D6478BD642F
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BLOCK_BYTES = 1 << 20

_BYTES = np.arange(256)
#: Words are runs of anything but a space and the five ASCII control blanks.
SPACED = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
#: Words are runs of digits, a-z and everything beyond ASCII.
PLAIN = (((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A))
         | (_BYTES >= 0x80))
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


class _Powers(dict):
    """What a process has computed stays with it."""

    def __reduce__(self) -> tuple:
        return _Powers, ()


_powers = _Powers()


def powers(factor: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd factor modulo 2**64, and their inverses."""
    if factor not in _powers or len(_powers[factor][0]) < n:
        size = max(n, 1 << 16)
        both = []
        for base in (factor, pow(factor, -1, 1 << 64)):
            row = np.full(size, base, dtype=np.uint64)
            row[0] = 1
            both.append(np.cumprod(row, dtype=np.uint64))
        _powers[factor] = (both[0], both[1])
    up, down = _powers[factor]
    return up[:n], down[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= MIX_1
    x ^= x >> np.uint64(27)
    x *= MIX_2
    x ^= x >> np.uint64(31)
    return x


def distinct(x: np.ndarray) -> np.ndarray:
    """The distinct values in ascending order, by sorting; ``np.unique`` alone hashes, which takes
    far longer and more memory on long arrays."""
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


@dataclass
class Words:
    """``first[d]`` is the index of the first word of text ``d``; one entry more ends the last."""

    data: bytes
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The number of the text each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def left(self) -> np.ndarray:
        """For each word, the number of words from it to the end of its text."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self.start))

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]]


def words_of(texts: list[bytes | None], is_word: np.ndarray = SPACED, lower: bool = False,
             cut: tuple[np.ndarray, np.ndarray] | None = None) -> Words:
    """Split texts (None: no words) into words; ``lower`` maps A-Z to a-z first.

    With ``cut``, a word also ends between two bytes of which the first is in the one table and
    the second in the other.
    """
    texts = [text or b"" for text in texts]
    data = b" ".join(texts) + b" "
    if lower:
        data = data.translate(LOWER)
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = is_word[raw]
    begins_here, ends_here = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    if cut:
        between = cut[0][raw[:-1]] & cut[1][raw[1:]]
        begins_here, ends_here = begins_here | between, ends_here | between
    start, end = np.flatnonzero(begins_here) + 1, np.flatnonzero(ends_here) + 1
    if inside[0]:
        start = np.concatenate(([0], start))
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    begins = np.concatenate(([0], np.cumsum(sizes + 1)))
    return Words(data, start, end, np.searchsorted(start, begins), _word_hashes(raw, start, end))


def _word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.empty(len(start), dtype=np.uint64)
    at = 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(end, start[at] + BLOCK_BYTES)))
        low, high = int(start[at]), int(end[to - 1])
        up, down = powers(BYTE_FACTOR, high - low + 1)
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum((raw[low:high].astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
        s, e = start[at:to] - low, end[at:to] - low
        out[at:to] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        at = to
    return out


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` consecutive entries; windows across texts are the caller's to drop."""
    if len(hashes) < n:
        return np.empty(0, dtype=np.uint64)
    up, down = powers(WORD_FACTOR, len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * up[:-1], out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * down[:len(hashes) - n + 1] + np.uint64(n))


def whole_hashes(words: Words) -> np.ndarray:
    """A hash of all words of each text, equal to the window hash of the same length."""
    up, down = powers(WORD_FACTOR, len(words.hashes) + 1)
    sums = np.zeros(len(words.hashes) + 1, dtype=np.uint64)
    np.cumsum(words.hashes * up[:-1], out=sums[1:])
    first, last = words.first[:-1], words.first[1:]
    return mix((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))
