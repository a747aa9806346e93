"""Numbers for hashes, and ranges of flat arrays: what tasks that meet a text once need."""

import numpy as np


class HashIndex:
    """Gives 64-bit hashes numbers from 0 on, in the order in which they are added."""

    def __init__(self) -> None:
        self.known = np.empty(0, dtype=np.uint64)
        self.number = np.empty(0, dtype=np.int64)

    def __len__(self) -> int:
        return len(self.known)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 where it is not known."""
        if not len(self.known):
            return np.full(len(hashes), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, self.number[at], -1)

    def add(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers for distinct ascending hashes that are not known yet."""
        numbers = np.arange(len(hashes)) + len(self.known)
        at = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, at, hashes)
        self.number = np.insert(self.number, at, numbers)
        return numbers


def ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The indices ``begin[i], ..., begin[i] + size[i] - 1`` of all i, one after another."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(begin - (ends - size), size) + np.arange(total)


def begins(sizes: np.ndarray) -> np.ndarray:
    """Where each of consecutive parts begins; one entry more ends the last."""
    return np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
