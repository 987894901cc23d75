"""Byte-pair merges of many words at once, on flat arrays."""

from __future__ import annotations

import numpy as np

NONE = np.int32(2**31 - 1)


class Merger:
    """Merge rounds over a table of pairs.

    ``pairs`` has rows (left id, right id, rank, merged id); a word merges its
    pair of least rank first, the leftmost of equals. ``size`` is an id that
    takes part in no pair. Merging all the occurrences of a pair in one round
    is right unless a merge may open a pair that comes first itself, or unless
    several pieces share a rank; those pairs merge one at a time.
    """

    def __init__(self, pairs: list[tuple[int, int, int, int]], size: int) -> None:
        table = np.array(sorted(pairs), np.int64).reshape(-1, 4)
        self.size = size
        self.keys = table[:, 0] * (size + 1) + table[:, 1]
        self.ranks = np.append(table[:, 2], NONE).astype(np.int32)
        self.merged = np.append(table[:, 3], size)
        rank_of = np.full(size + 1, -1, np.int64)
        rank_of[table[:, 3]] = table[:, 2]
        unsafe = np.zeros(size + 1, bool)
        for side in (0, 1):
            unsafe[table[table[:, 2] <= rank_of[table[:, side]], side]] = True
        pieces = {}
        for rank, piece in table[:, 2:].tolist():
            pieces.setdefault(rank, set()).add(piece)
        tied = np.array([len(pieces[r]) > 1 for r in table[:, 2].tolist()], bool)
        self.one_by_one = np.append(unsafe[table[:, 3]] | tied, False)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of each pair among the mergeable ones; the last index stands for none."""
        key = left.astype(np.int64) * (self.size + 1) + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, at, len(self.keys))

    def merge(self, symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Merges within each word. Returns symbols, first characters and bounds of all words.

        ``symbols[bounds[w]:bounds[w + 1]]`` are the characters of word w, of at least one.
        """
        none = len(self.keys)
        word = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        char = np.arange(len(symbols))
        done: list[tuple[np.ndarray, ...]] = []

        def pairs_at(at: np.ndarray) -> np.ndarray:
            after = np.minimum(at + 1, len(symbols) - 1)
            out = self.pair(symbols[at], symbols[after])
            out[(after == at) | (word[after] != word[at])] = none
            return out

        pair = pairs_at(np.arange(len(symbols)))
        while len(symbols):
            rank = self.ranks[pair]
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            lengths = np.diff(np.append(starts, len(word)))
            best = np.minimum.reduceat(rank, starts)
            if (over := best == NONE).any():
                gone = np.repeat(over, lengths)
                done.append((word[gone], symbols[gone], char[gone]))
                stay = ~gone
                symbols, word, char, pair, rank = symbols[stay], word[stay], char[stay], pair[stay], rank[stay]
                lengths, best = lengths[~over], best[~over]
                if not len(symbols):
                    break
                starts = np.cumsum(lengths) - lengths
            at = np.flatnonzero(rank == np.repeat(best, lengths))
            first = np.append(True, word[at[1:]] != word[at[:-1]])
            run = np.append(True, at[1:] != at[:-1] + 1) | first  # of pairs that overlap: each second one merges
            begin = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            take = (np.arange(len(at)) - begin) % 2 == 0
            alone = self.one_by_one[pair[at]]
            word_alone = np.repeat(np.logical_or.reduceat(alone, np.flatnonzero(first)), np.diff(np.append(np.flatnonzero(first), len(at))))
            at = at[take & (first | ~word_alone)]
            symbols[at] = self.merged[pair[at]]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            moved = at - np.arange(len(at))  # where the merged symbols stand after compaction
            symbols, word, char, pair = symbols[stay], word[stay], char[stay], pair[stay]
            touched = np.zeros(len(symbols), bool)
            touched[moved] = True
            touched[np.maximum(moved - 1, 0)] = True
            changed = np.flatnonzero(touched)
            pair[changed] = pairs_at(changed)
        words, out, chars = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (word, symbols, char)
        order = np.argsort(words, kind="stable")
        ends = np.zeros(len(bounds), np.int64)
        np.cumsum(np.bincount(words, minlength=len(bounds) - 1), out=ends[1:])
        return out[order], chars[order], ends
