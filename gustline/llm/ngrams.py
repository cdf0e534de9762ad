"""Hashed character n-grams of many words at once, in numpy."""

from __future__ import annotations

import numpy as np

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))


def grams(words: list[str], sizes: tuple[int, ...], buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each size: (bucket, word number) of all n-grams, by word. Words get a begin and an end mark."""
    marked = [f"\x02{w}\x03" for w in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    lengths = np.array([len(m) for m in marked], dtype=np.int64)
    word = np.repeat(np.arange(len(words)), lengths)
    left = np.cumsum(lengths)[word] - np.arange(len(codes)) if len(words) else word
    out = []
    for n in sizes:
        count = max(0, len(codes) - n + 1)
        h = np.full(count, n, dtype=np.uint64)
        for j in range(n):
            h = (h ^ codes[j : j + count]) * _MIX[0]
            h ^= h >> np.uint64(29)
        h *= _MIX[1]
        keep = left[:count] >= n
        out.append((((h >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)[keep], word[:count][keep]))
    return out


def summed(found: list[tuple[np.ndarray, np.ndarray]], table: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Per word: the sum of its n-grams' rows of ``table``, and their number."""
    total = np.zeros((n_words, table.shape[1]), dtype=table.dtype)
    count = np.zeros(n_words, dtype=np.int64)
    for ids, word in found:
        if len(ids):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            total[word[first]] += np.add.reduceat(table[ids], first, axis=0)
            count += np.bincount(word, minlength=n_words)
    return total, count


class WordCache:
    """Rows of values per word, made in batches; emptied when it holds ``size`` words.

    ``make`` gives the rows of a list of words. Row 0 stays zero, for padding.
    """

    def __init__(self, make, width: int, size: int, batch: int = 4096) -> None:
        self._make, self._batch, self._size = make, batch, size
        self.rows = np.zeros((1024, width), dtype=np.float32)
        self._known: dict[str, int] = {}

    def numbers(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Row numbers of each text's words, valid until the next call."""
        here = set().union(*texts)
        new = here.difference(self._known)
        if len(self._known) + len(new) > self._size:
            self._known.clear()
            new = here
        fresh, at = sorted(new), len(self._known) + 1
        if at + len(fresh) > len(self.rows):
            grown = np.zeros((max(2 * len(self.rows), at + len(fresh)), self.rows.shape[1]), dtype=np.float32)
            grown[:at] = self.rows[:at]
            self.rows = grown
        for i in range(0, len(fresh), self._batch):
            some = fresh[i : i + self._batch]
            self.rows[at + i : at + i + len(some)] = self._make(some)
        self._known.update(zip(fresh, range(at, at + len(fresh))))
        number = self._known.__getitem__
        return [np.fromiter(map(number, words), np.int64, len(words)) for words in texts]
