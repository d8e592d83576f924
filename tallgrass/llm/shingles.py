"""Sets of hashed word shingles, computed for many texts at once."""

from __future__ import annotations

import numpy as np

_U = np.uint64
#: Odd multipliers of the hashes (fixed values; any odd numbers would do).
_STEP, _MIX_A, _MIX_B = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over the whole range; a bijection."""
    x = (x ^ (x >> _U(30))) * _MIX_A
    x = (x ^ (x >> _U(27))) * _MIX_B
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Shingler:
    """Distinct ``width``-word shingles of texts, as sorted 64-bit hashes.

    Words are runs of other bytes than blank, tab, LF, VT, FF, CR, with A-Z lower-cased.  A text of
    fewer words has its whole sequence as its one shingle; one without words has none.
    """

    def __init__(self, width: int):
        if width < 1:
            raise ValueError("width must be at least 1")
        self.width = width
        fold = np.arange(256)
        fold[65:91] += 32
        self.value = mix((fold.astype(np.uint64) + _U(1)) * _STEP)
        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            base = int(_STEP)
            self.up, self.down = _powers(base, n), _powers(pow(base, -1, 1 << 64), n)

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each word of all texts in order, and the text it belongs to."""
        raw = [t.encode("utf-8", "replace") for t in texts]
        data = np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)
        gap = self.space[data]
        begin = np.nonzero(gap[:-1] & ~gap[1:])[0] + 1
        end = np.nonzero(~gap[:-1] & gap[1:])[0] + 1
        self._grow(len(data) + 1)
        # sums of value * base ** position; divided by base ** begin they do not depend on the place
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.value[data] * self.up[:len(data)], dtype=np.uint64)])
        hashes = mix((total[end] - total[begin]) * self.down[begin] + (end - begin).astype(np.uint64) * _MIX_B)
        starts = np.cumsum([1, *(len(r) + 1 for r in raw)])
        return hashes, np.searchsorted(starts, begin, side="right") - 1

    def sets(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All distinct shingles, text by text and sorted in each, and how many each text has."""
        words, owner = self.words(texts)
        n = np.bincount(owner, minlength=len(texts))
        first = np.cumsum(n) - n
        short = np.nonzero((n > 0) & (n < self.width))[0]
        whole = np.nonzero(owner[: len(owner) - self.width + 1] == owner[self.width - 1 :])[0] if len(words) >= self.width else np.zeros(0, np.int64)
        made = np.zeros(len(whole), np.uint64)
        for j in range(self.width):
            made = mix(made * _STEP + words[whole + j])
        texts_of = owner[whole]
        if len(short):
            few = []
            for k in short:
                h = np.zeros(1, np.uint64)
                for w in words[first[k]:first[k] + n[k]]:
                    h = mix(h * _STEP + w)
                few.append(mix(h + _U(n[k]))[0])
            made, texts_of = np.append(made, np.array(few, np.uint64)), np.append(texts_of, short)
        order = np.lexsort((made, texts_of))
        made, texts_of = made[order], texts_of[order]
        new = np.ones(len(made), bool)
        new[1:] = (made[1:] != made[:-1]) | (texts_of[1:] != texts_of[:-1])
        return made[new], np.bincount(texts_of[new], minlength=len(texts))


def runs_of(count: np.ndarray) -> np.ndarray:
    """Where each run begins."""
    return np.cumsum(count) - count


def sum_runs(values: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Sum of each run, modulo 2 ** 64."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    end = np.cumsum(count)
    return total[end] - total[end - count]
