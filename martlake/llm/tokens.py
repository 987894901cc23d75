"""Word tokens of many texts at once, as hashes."""

from __future__ import annotations

import unicodedata

import numpy as np

from martlake.llm.flat import Mixers, codepoints, kept, span_hashes

LETTER, SPACE, OTHER = range(3)


def _kinds() -> np.ndarray:
    table = np.full(0x110000, OTHER, np.int8)
    for c in range(0x30000):
        ch = chr(c)
        if ch.isspace():
            table[c] = SPACE
        elif unicodedata.category(ch)[0] in "LNM":
            table[c] = LETTER
    return table


class Tokens:
    """Tokens of texts: runs of letters and digits, and runs of other characters that are not blank.

    ``starts`` and ``ends`` are places among ``points``; ``bounds`` says which
    tokens belong to which text.
    """

    def __init__(self, texts: list[str]) -> None:
        self.mixers = kept(("mixers",), Mixers)
        kinds = kept(("token_kinds",), _kinds)
        self.points, self.text_bounds = codepoints([t.lower() for t in texts])
        kind = kinds[self.points]
        begins = np.append(True, kind[1:] != kind[:-1]) if len(kind) else np.zeros(0, bool)
        begins[self.text_bounds[:-1][self.text_bounds[:-1] < len(kind)]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(kind)) if len(kind) else starts
        full = kind[starts] != SPACE
        self.starts, self.ends = starts[full], ends[full]
        self.is_word = kind[self.starts] == LETTER
        self.bounds = np.searchsorted(self.starts, self.text_bounds)
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.bounds))

    def hashes(self, longest: int | None = None) -> np.ndarray:
        """A 64-bit hash of each token, or of its first ``longest`` characters."""
        ends = self.ends if longest is None else np.minimum(self.ends, self.starts + longest)
        return span_hashes(self.points, self.starts, ends, self.mixers)
