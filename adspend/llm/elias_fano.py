"""Elias-Fano sequences and a memory-mapped bigram trie, in numpy."""

from __future__ import annotations

import tempfile

import numpy as np

CHUNK = 1 << 16


class Monotone:
    """A non-decreasing sequence in Elias-Fano form.

    The low bits of each value are packed side by side; the high parts are unary gaps in a
    bit vector, where the i-th one bit at position p stands for the high part p - i. About
    ``2 + log2(universe / n)`` bits a value.
    """

    def __init__(self, values: np.ndarray, universe: int):
        n = len(values)
        self.n = n
        self.low_bits = max(0, (max(universe, 1) // max(n, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        high = (values >> np.uint64(self.low_bits)).astype(np.int64) if self.low_bits < 64 else np.zeros(n, np.int64)
        ones = high + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bits[ones] = 1
        self.high = np.packbits(bits)
        # where each chunk of values starts in the bit vector
        self.marks = ones[::CHUNK].copy()
        low = []
        for a in range(0, n, CHUNK):
            part = values[a:a + CHUNK]
            rows = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)[:, 64 - self.low_bits:]
            low.append(np.packbits(rows))
        self.low = np.concatenate([np.zeros(0, np.uint8), *low])

    def parts(self) -> list[np.ndarray]:
        return [self.high, self.low]

    def replace(self, high: np.ndarray, low: np.ndarray) -> None:
        """Use the given (mapped) copies of ``parts``."""
        self.high, self.low = high, low

    def chunk(self, k: int) -> np.ndarray:
        """The values of the k-th chunk."""
        a = k * CHUNK
        m = min(CHUNK, self.n - a)
        first = int(self.marks[k])
        last = int(self.marks[k + 1]) if k + 1 < len(self.marks) else len(self.high) * 8
        byte = first // 8
        ones = np.flatnonzero(np.unpackbits(self.high[byte:-(-last // 8)]))
        ones = ones[ones >= first - byte * 8][:m] + byte * 8
        out = (ones - np.arange(a, a + m)).astype(np.uint64)
        if not self.low_bits:
            return out
        width = -(-CHUNK * self.low_bits // 8)
        bits = np.unpackbits(self.low[k * width:(k + 1) * width])[:m * self.low_bits].reshape(m, self.low_bits)
        full = np.zeros((m, 64), np.uint8)
        full[:, 64 - self.low_bits:] = bits
        low = np.packbits(full, axis=1).reshape(-1, 8).copy().view(">u8").reshape(-1).astype(np.uint64)
        return (out << np.uint64(self.low_bits) if self.low_bits < 64 else np.zeros(m, np.uint64)) | low

    def successors(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For ascending queries: the place of the first value not less, and whether it is equal."""
        place = np.full(len(queries), self.n, np.int64)
        equal = np.zeros(len(queries), bool)
        done = 0
        for k in range(-(-self.n // CHUNK)):
            if done == len(queries):
                break
            values = self.chunk(k)
            upto = done + int(np.searchsorted(queries[done:], values[-1], "right"))
            at = np.searchsorted(values, queries[done:upto])
            place[done:upto] = k * CHUNK + at
            equal[done:upto] = values[at] == queries[done:upto]
            done = upto
        return place, equal


class Quantised:
    """Numbers on a grid of 256 steps between the least and the largest."""

    def __init__(self, values: np.ndarray):
        self.least = float(values.min()) if len(values) else 0.0
        self.step = ((float(values.max()) - self.least) / 255 if len(values) else 0.0) or 1.0
        self.codes = np.rint((values - self.least) / self.step).astype(np.uint8)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return self.least + self.step * self.codes[at]


class Trie:
    """Contexts, and the successors of each, with quantised log10 probabilities.

    Level 1 has the contexts (64-bit hashes); level 2 has the successors of all contexts in one
    sequence, made monotone by the rank of their context: ``rank << 32 | successor``. Pointers
    from level 1 give each context's range of level 2. All levels lie in one mapped file
    without a name, which goes with the process.
    """

    def __init__(self, contexts: np.ndarray, pointers: np.ndarray, successors: np.ndarray, hit: np.ndarray, back: np.ndarray):
        """``pointers``: the end of each context's range; ``hit``: log10 p of each successor;
        ``back``: log10 of what each context leaves to other words."""
        rank = np.repeat(np.arange(len(contexts), dtype=np.uint64), np.diff(np.append(0, pointers)))
        self.contexts = Monotone(contexts, 1 << 64)
        self.pointers = Monotone(pointers, len(successors) + 1)
        self.successors = Monotone(rank << np.uint64(32) | successors.astype(np.uint64), max(len(contexts), 1) << 32)
        self.hit, self.back = Quantised(hit), Quantised(back)
        self._map()

    def _map(self) -> None:
        sequences = (self.contexts, self.pointers, self.successors)
        levels = [p for s in sequences for p in s.parts()] + [self.hit.codes, self.back.codes]
        edges = np.cumsum([0, *map(len, levels)])
        self.bytes = int(edges[-1])
        if not self.bytes:
            return
        with tempfile.TemporaryFile() as f:
            for level in levels:
                f.write(level.tobytes())
            f.flush()
            mapped = np.memmap(f, np.uint8, "r")
        views = [mapped[a:b] for a, b in zip(edges, edges[1:])]
        for k, s in enumerate(sequences):
            s.replace(views[2 * k], views[2 * k + 1])
        self.hit.codes, self.back.codes = views[6], views[7]

    def search(self, contexts: np.ndarray, successors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For queries ascending by context and successor: the context's place and whether it is
        known, the successor's place and whether it follows the context."""
        place, known = self.contexts.successors(contexts)
        rank = np.where(known, place, 0).astype(np.uint64)
        at = np.zeros(len(contexts), np.int64)
        follows = np.zeros(len(contexts), bool)
        at[known], follows[known] = self.successors.successors((rank << np.uint64(32) | successors.astype(np.uint64))[known])
        return place, known, at, follows
