"""Sets of word shingles, as sorted arrays of hashes."""

from __future__ import annotations

import numpy as np

from martlake.llm.flat import Mixers, chunks, codepoints, kept, mix, span_hashes

WIDTH = 5
MULTIPLIER = np.uint64(0xD6E8FEB86659FD93)


def _word_spans(points: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words are runs of anything but blank, tab and the line ends 0x0A to 0x0D."""
    inside = ~((points == 0x20) | ((points >= 0x09) & (points <= 0x0D)))
    text_begin = np.zeros(len(points) + 1, bool)
    text_begin[bounds] = True
    begins = inside & (~np.append(False, inside[:-1]) | text_begin[:-1])
    ends = inside & (~np.append(inside[1:], False) | text_begin[1:])
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def _chunk_sets(texts: list[str], width: int) -> list[np.ndarray]:
    points, bounds = codepoints(texts)
    points = np.where((points >= 0x41) & (points <= 0x5A), points + np.uint32(32), points)
    starts, ends = _word_spans(points, bounds)
    words = span_hashes(points, starts, ends, kept(("mixers",), Mixers))
    cut = np.searchsorted(starts, bounds)
    n = max(len(words) - width + 1, 0)
    full = np.full(n, np.uint64(width))
    for k in range(width):
        full = full * MULTIPLIER + words[k : k + n]
    full = mix(full)
    out = []
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        if b - a >= width:
            whole = np.sort(full[a : b - width + 1])
            out.append(whole[np.append(True, whole[1:] != whole[:-1])])
        elif b > a:
            one = np.full(1, np.uint64(b - a))
            for k in range(a, b):
                one = one * MULTIPLIER + words[k : k + 1]
            out.append(mix(one))
        else:
            out.append(words[:0])
    return out


def shingle_sets(texts: list[str], width: int = WIDTH) -> list[np.ndarray]:
    """For each text the sorted hashes of its distinct shingles of ``width`` words.

    A text with fewer words has its whole sequence as one shingle, a text
    without words none. A-Z are lower-cased, other characters stay.
    """
    out: list[np.ndarray] = []
    for a, b in chunks(texts):
        out += _chunk_sets(texts[a:b], width)
    return out


def signature(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    parts = (shingles * MULTIPLIER, mix(shingles ^ np.uint64(0xA5A5A5A5)))
    return tuple(int(mix(np.array([p.sum(dtype=np.uint64) + np.uint64(len(p))]))[0].astype(np.int64)) for p in parts)
