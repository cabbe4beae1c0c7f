"""Word shingles and SuperMinHash signatures of a batch of texts, in numpy."""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import xxhash

SHINGLE = 5
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
CACHE_WORDS = 300_000


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """64-bit hashes of the words of texts: A-Z lower-cased, split at ASCII white space."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = defaultdict(count().__next__)
        self.hashes = np.empty(0, np.uint64)

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words of all texts one after another, and the number of each text's."""
        if len(self.number) > CACHE_WORDS:
            self.__init__()
        codes: list[int] = []
        sizes = np.empty(len(texts), np.int64)
        number = self.number.__getitem__
        for k, text in enumerate(texts):
            before = len(codes)
            if text:
                codes += map(number, text.encode("utf-8", "surrogatepass").lower().split())
            sizes[k] = len(codes) - before
        if (new := len(self.number) - len(self.hashes)) > 0:
            words = list(self.number)[-new:]
            fresh = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, new)
            self.hashes = np.concatenate([self.hashes, fresh])
        return self.hashes[np.array(codes, np.int64)], sizes


def shingle_sets(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text one after another, and their numbers.

    A text with fewer than five words has its whole sequence as the one shingle; without
    words the set is empty.
    """
    n = len(words)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    ends = np.cumsum(sizes)
    left = ends[owner] - np.arange(n) if n else np.empty(0, np.int64)
    hashed = np.zeros(n, np.uint64)
    wide = np.concatenate([words, np.zeros(SHINGLE, np.uint64)])
    for k in range(SHINGLE):
        hashed = np.where(left > k, hashed * GOLDEN + wide[k:k + n] + np.uint64(1), hashed)
    first = np.arange(n) == (ends - sizes)[owner] if n else np.empty(0, bool)
    use = (left >= SHINGLE) | (first & (sizes[owner] < SHINGLE))
    owner, hashed = owner[use], mix64(hashed[use])
    order = np.lexsort((hashed, owner))
    owner, hashed = owner[order], hashed[order]
    keep = np.ones(len(owner), bool)
    keep[1:] = (owner[1:] != owner[:-1]) | (hashed[1:] != hashed[:-1])
    return hashed[keep], np.bincount(owner[keep], minlength=len(sizes))


def superminhash(elements: np.ndarray, sizes: np.ndarray, m: int, chunk: int = 1 << 18) -> np.ndarray:
    """SuperMinHash signatures, one row of m uint64 for each set (empty sets: all ones).

    Every element draws a random permutation of the m slots step by step; in step j it
    offers slot p(j) the value j + u(j), kept as ``j << 32 | u``. A slot keeps its least
    offer. A set stops as soon as all its slots hold values of earlier steps, which later
    steps cannot beat. The permutations are drawn by Fisher-Yates from a hash of the element.
    """
    out = np.full((len(sizes), m), np.uint64(2**64 - 1))
    cut = (np.cumsum(sizes) // chunk).astype(np.int64)
    edges = [0, *(np.flatnonzero(np.diff(cut)) + 1).tolist(), len(sizes)]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    for a, b in zip(edges, edges[1:]):
        part = elements[ends[a]:ends[b]]
        owner = np.repeat(np.arange(b - a), sizes[a:b])
        slots = out[a:b].reshape(-1)
        swaps = None
        for j in range(m):
            draw = mix64(part + np.uint64((j + 1) * int(GOLDEN) % 2**64))
            k = j + ((draw >> np.uint64(32)) * np.uint64(m - j) >> np.uint64(32)).astype(np.int64)
            offer = np.uint64(j) << np.uint64(32) | draw & np.uint64(0xFFFFFFFF)
            if j == 0:
                slot, first = k, k
            else:
                if swaps is None:
                    swaps = np.tile(np.arange(m, dtype=np.uint16), (len(part), 1))
                    swaps[np.arange(len(part)), first] = 0
                at = np.arange(len(part))
                slot = swaps[at, k].astype(np.int64)
                swaps[at, k] = swaps[:, j]
            np.minimum.at(slots, owner * m + slot, offer)
            busy = slots.reshape(-1, m).max(1) >= np.uint64(j + 1) << np.uint64(32)
            go = busy[owner]
            if not go.all():
                part, owner = part[go], owner[go]
                first = first[go]
                swaps = swaps[go] if swaps is not None else None
            if not len(part):
                break
    return out
