"""Hashed byte n-grams of whole texts, computed on arrays."""

from __future__ import annotations

import numpy as np

#: N-gram starts that are hashed together; bounds the memory of a long text.
CHUNK = 1 << 20
#: Characters at which a text's frequencies count half.
HALF_TRUST = 60
#: How much more a mark counts than a hashed place.
MARK_WEIGHT = 8
# Odd multipliers of the hash.
MULTIPLY, FINISH = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class NgramSpace:
    """Relative frequencies of byte n-grams of several orders in ``1 << bits`` hashed places.

    Each order's frequencies of a text sum to 1, so long and short texts are comparable. ``marks``
    adds a place for words equal to the word before, and one each for upper case, digits and signs.
    """

    def __init__(self, bits: int, orders: tuple[int, ...], lower: bool, marks: bool = False) -> None:
        self.bits, self.orders, self.lower, self.marks = bits, orders, lower, marks
        self.size = (1 << bits) + (4 if marks else 0)

    def _buffer(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        data = [(t.lower() if self.lower else t).encode() for t in texts]
        ends = np.cumsum([0, *map(len, data)])
        return np.frombuffer(b"".join(data) + bytes(8), np.uint8), ends

    def _hashes(self, buffer: np.ndarray, a: int, b: int, order: int) -> np.ndarray:
        code = np.zeros(b - a, np.uint64)
        for k in range(order):
            code = (code << np.uint64(8)) | buffer[a + k : b + k]
        code = (code + np.uint64(order)) * MULTIPLY
        code ^= code >> np.uint64(29)
        return ((code * FINISH) >> np.uint64(64 - self.bits)).astype(np.intp)

    def _marks(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), 4), np.float32)
        for i, text in enumerate(texts):
            words = text.split()
            if not words:
                continue
            n = len(text)
            letters = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            upper = np.count_nonzero((letters >= 65) & (letters <= 90))
            digits = np.count_nonzero((letters >= 48) & (letters <= 57))
            plain = np.count_nonzero((letters >= 97) | (letters == 32) | (letters == 10))
            same = sum(map(str.__eq__, words[1:], words))
            out[i] = same / len(words), upper / n, digits / n, (n - plain - upper - digits) / n
        return out

    @staticmethod
    def trust(texts: list[str]) -> np.ndarray:
        sizes = np.fromiter(map(len, texts), np.float64, len(texts))
        return sizes / (sizes + HALF_TRUST)

    def rows(self, texts: list[str]) -> np.ndarray:
        """A dense row per text; the last number is its trust."""
        buffer, ends = self._buffer(texts)
        out = np.zeros((len(texts), self.size + 1), np.float32)
        for i in range(len(texts)):
            for order in self.orders:
                grams = ends[i + 1] - ends[i] - order + 1
                for a in range(ends[i], ends[i] + max(grams, 0), CHUNK):
                    h = self._hashes(buffer, a, min(a + CHUNK, ends[i] + grams), order)
                    out[i, : 1 << self.bits] += np.bincount(h, minlength=1 << self.bits) / grams
        if self.marks:
            out[:, -5:-1] = self._marks(texts)
        out[:, -1] = self.trust(texts)
        return out

    def scores(self, texts: list[str], weights: np.ndarray) -> np.ndarray:
        """``rows(texts)[:, :-1] @ weights`` without making the rows; ``weights`` has a column a score."""
        buffer, ends = self._buffer(texts)
        out = np.zeros((len(texts), weights.shape[1]))
        columns = [np.ascontiguousarray(w, np.float32) for w in weights[: 1 << self.bits].T]
        for order in self.orders:
            grams = np.maximum(np.diff(ends) - order + 1, 0)
            stops = ends[:-1] + grams
            for a in range(0, int(ends[-1]), CHUNK):
                b = min(a + CHUNK, int(ends[-1]))
                first, last = np.searchsorted(ends, a, "right") - 1, np.searchsorted(ends, b, "left")
                lo = np.clip(ends[first:last], a, b) - a
                hi = np.maximum(np.clip(stops[first:last], a, b) - a, lo)
                h = self._hashes(buffer, a, b, order)
                share = 1 / np.maximum(grams[first:last], 1)
                for k, column in enumerate(columns):
                    total = np.concatenate(([0.0], np.cumsum(column[h], dtype=np.float64)))
                    out[first:last, k] += (total[hi] - total[lo]) * share
        if self.marks:
            out += self._marks(texts) @ weights[-4:]
        return out

    def standardised(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of deviations from the means, means and divisors, for fitting a linear model.

        Rare places keep smaller deviations; marks count ``MARK_WEIGHT`` times; a short text's
        deviations shrink, for its frequencies say little.
        """
        x, trust = rows[:, :-1], rows[:, -1:]
        mean = x.mean(0)
        spread = x.std(0) + 1e-4
        if self.marks:
            spread[-4:] /= MARK_WEIGHT
        return trust * (x - mean) / spread, mean, spread

    def linear(self, texts: list[str], weights: np.ndarray, mean: np.ndarray) -> np.ndarray:
        """What linear models on ``standardised`` rows give; ``weights`` are divided by ``spread``."""
        return (self.scores(texts, weights) - mean @ weights) * self.trust(texts)[:, None]
