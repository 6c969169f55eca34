"""Splitting texts for a byte-level vocabulary, as its tokenizer file does, without one object per word.

The pattern: contractions, an optional space with letters, with numbers or with other signs, white space without
the last character before a word, white space.
"""

from __future__ import annotations

import numpy as np

from meldspark.llm.spans import lead_code_points

LETTER, NUMBER, OTHER, WHITE = range(4)
CONTRACTIONS = (b"s", b"t", b"m", b"d", b"re", b"ve", b"ll")


class Splitter:
    """Splits the rows of a chunk into pre-tokens and special tokens.

    The class of a character beyond ASCII is asked from the tokenizer's own pre-tokenizer once, so both
    agree on every Unicode version.
    """

    def __init__(self, tokenizer):
        self._pre = tokenizer.pre_tokenizer
        self._ascii = np.array([self._class(chr(c)) for c in range(128)], np.uint8)
        self._beyond: dict[int, int] = {}
        self.special = {t.content.encode(): i for i, t in tokenizer.get_added_tokens_decoder().items()}

    def _class(self, char: str) -> int:
        for kind, mate in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")):
            if len(self._pre.pre_tokenize_str(mate + char)) == 1:
                return kind
        return WHITE

    def _classes(self, data: np.ndarray) -> np.ndarray:
        kinds = self._ascii[data & 127]
        at, point, length = lead_code_points(data)
        if len(at):
            points, inverse = np.unique(point, return_inverse=True)
            for p in points.tolist():
                if p not in self._beyond:
                    valid = p < 0x110000 and not 0xD800 <= p < 0xE000
                    self._beyond[p] = self._class(chr(p)) if valid else OTHER
            of = np.array([self._beyond[p] for p in points.tolist()], np.uint8)[inverse]
            for k in range(4):
                more = (length > k) & (at + k < len(data))
                kinds[at[more] + k] = of[more]
        return kinds

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, row of each, special id or -1)."""
        size = len(data)
        if not size:
            none = np.zeros(0, np.int64)
            return none, none, none, none
        border = np.zeros(size + 1, bool)
        border[offsets] = True
        specials: dict[int, int] = {}
        raw = data.tobytes()
        for text, number in self.special.items():
            at = raw.find(text)
            while at >= 0:
                if not border[at + 1 : at + len(text)].any():
                    specials[at] = number
                    border[[at, at + len(text)]] = True
                    at = raw.find(text, at + len(text))
                else:
                    at = raw.find(text, at + 1)
        kinds = self._classes(data)
        run = np.empty(size, bool)
        run[0] = True
        run[1:] = kinds[1:] != kinds[:-1]
        run |= border[:size]
        start = run.copy()
        after = np.flatnonzero(run[1:] & ~border[1:size] & (kinds[:-1] == WHITE)) + 1
        last = after - 1
        while (inside := (data[last] & 0xC0) == 0x80).any():
            last = last - inside
        start[last] = True
        start[after[data[after - 1] == 0x20]] = False
        for q in np.flatnonzero((data == 0x27) & start).tolist():
            for tail in CONTRACTIONS:
                end = q + 1 + len(tail)
                if raw[q + 1 : end] == tail and not border[q + 1 : end].any():
                    start[q + 1 : end] = False
                    if end < size:
                        start[end] = True
                    break
        for at in specials:
            start[at + 1 : at + len(next(t for t, i in self.special.items() if i == specials[at]))] = False
        starts = np.flatnonzero(start)
        ends = np.append(starts[1:], size)
        rows = np.searchsorted(offsets, starts, side="right") - 1
        number = np.full(len(starts), -1, np.int64)
        for at, value in specials.items():
            number[np.searchsorted(starts, at)] = value
        return starts, ends, rows, number
