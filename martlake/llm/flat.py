"""Text as flat numpy arrays: code points, token hashes, ragged gathers."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 19  # code points handled at once; one longer text is a chunk of its own
BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words with well spread bits (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Mixers:
    """Pseudo-random words for each code point and for each place in a span, the latter grown as needed."""

    def __init__(self) -> None:
        self.point = mix(np.arange(0x110000, dtype=np.uint64) + np.uint64(0x51ED27))
        self.place = np.zeros(0, np.uint64)

    def places(self, n: int) -> np.ndarray:
        if n > len(self.place):
            self.place = mix(np.arange(max(n, 1 << 12), dtype=np.uint64) + np.uint64(BASE)) | np.uint64(1)
        return self.place


def span_hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray, mixers: Mixers) -> np.ndarray:
    """A 64-bit hash of the code points ``points[start:end]`` for each span; spans follow one another and don't overlap.

    Each code point is mixed with its place before all are added: there is no
    power of a base behind it, whose sums collide on words of a regular build.
    """
    lengths = ends - starts
    place = mixers.places(int(lengths.max(initial=0)))
    if lengths.sum() == len(points):  # spans leave no gap
        inside, own = points, np.cumsum(lengths) - lengths
    else:
        inside, bounds = gather(points, np.ravel(np.column_stack([starts, ends])), np.arange(0, 2 * len(starts), 2))
        own = bounds[:-1]
    at = np.arange(len(inside))
    at -= np.repeat(own, lengths)
    mixed = mixers.point[inside]
    mixed *= place[at]
    mixed ^= mixed >> np.uint64(32)
    sums = np.zeros(len(inside) + 1, np.uint64)
    np.cumsum(mixed, out=sums[1:])
    return mix(sums[own + lengths] - sums[own] + lengths.astype(np.uint64) * np.uint64(BASE))


def small_batches(batches, rows: int = 512):
    """Arrow batches in slices of at most ``rows`` rows, so that few texts are Python strings at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about CHUNK code points."""
    first = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > CHUNK:
            yield first, i
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)


def codepoints(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points in a row, and where each text begins (one more entry than texts)."""
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), bounds


def gather(data: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ragged rows of ``data`` one after another, and where each begins."""
    lengths = offsets[rows + 1] - offsets[rows]
    bounds = np.zeros(len(rows) + 1, np.int64)
    np.cumsum(lengths, out=bounds[1:])
    index = np.repeat(offsets[rows] - bounds[:-1], lengths)
    index += np.arange(bounds[-1])
    return data[index], bounds


def ragged(rows: list) -> tuple[np.ndarray, np.ndarray]:
    """Lists of integers as one array and offsets."""
    offsets = np.zeros(len(rows) + 1, np.int64)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    return np.array([x for r in rows for x in r], np.int64), offsets


class WordCache:
    """Ids of distinct words; emptied when it holds ``most`` of them, or MOST_POINTS code points.

    ``encode(points, bounds)`` gives the ids of words, as array and offsets. Words
    are found by hash, and each is compared with the one that the cache holds:
    one that differs is encoded by itself, so that the ids of a word don't depend
    on other words.
    """

    MOST_POINTS = 1 << 23

    def __init__(self, encode, most: int = 500_000) -> None:
        self.encode, self.most = encode, most
        self.clear()

    def clear(self) -> None:
        self.hashes, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.data, self.offsets = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.points, self.word_at = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def ids(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and where those of each word begin."""
        order = np.argsort(hashes)
        ordered = hashes[order]
        new = np.append(True, ordered[1:] != ordered[:-1]) if len(ordered) else np.zeros(0, bool)
        distinct, first = ordered[new], order[new]
        if len(self.hashes) > self.most or len(self.points) > self.MOST_POINTS:
            self.clear()
        at = np.searchsorted(self.hashes, distinct)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == distinct[known]
        if not known.all():
            fresh = ~known
            words, bounds = self._words(points, starts, ends, first[fresh])
            data, offsets = self.encode(words, bounds)
            rows = np.arange(len(self.offsets) - 1, len(self.offsets) - 1 + len(offsets) - 1)
            self.offsets = np.concatenate([self.offsets, offsets[1:] + len(self.data)])
            self.data = np.concatenate([self.data, data.astype(np.int32)])
            self.word_at = np.concatenate([self.word_at, bounds[1:] + len(self.points)])
            self.points = np.concatenate([self.points, words])
            self.rows = np.insert(self.rows, at[fresh], rows)
            self.hashes = np.insert(self.hashes, at[fresh], distinct[fresh])
            at = np.searchsorted(self.hashes, distinct)
        row = np.empty(len(hashes), np.int64)
        row[order] = self.rows[at][np.cumsum(new) - 1]
        other = self._differs(points, starts, ends, row)
        if not len(other):
            return gather(self.data, self.offsets, row)
        data, offsets = self.encode(*self._words(points, starts, ends, other))
        row[other] = len(self.offsets) - 1 + np.arange(len(other))
        return gather(np.concatenate([self.data, data.astype(np.int32)]), np.concatenate([self.offsets, offsets[1:] + len(self.data)]), row)

    @staticmethod
    def _words(points: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        spans = np.ravel(np.column_stack([starts[which], ends[which]]))
        return gather(points, np.append(spans, 0), np.arange(0, len(spans), 2))

    def _differs(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Words that are not the cached ones of ``row``, by their characters."""
        lengths = ends - starts
        off = lengths != self.word_at[row + 1] - self.word_at[row]
        lengths = np.where(off, 0, lengths)
        bounds = np.cumsum(lengths) - lengths
        at = np.arange(lengths.sum())
        unequal = points[at + np.repeat(starts - bounds, lengths)] != self.points[at + np.repeat(self.word_at[row] - bounds, lengths)]
        if unequal.any():
            off[np.repeat(np.arange(len(row)), lengths)[unequal]] = True
        return np.flatnonzero(off)


def kept(key: tuple, make):
    """One object for a Python worker, kept from task to task: tables and caches, no results."""
    store = sys.modules.setdefault("_martlake_llm_kept", types.ModuleType("_martlake_llm_kept")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]
