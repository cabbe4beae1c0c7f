"""Noisy-channel restoration of disguised words under a character language model."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np

# The letters of the character model (place 0 is the word border) and what a
# look-alike may stand for.
LETTERS = " abcdefghijklmnopqrstuvwxyzàáâäçèéêëìíîïñòóôöùúûüß"
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "(": "c",
}
ORDER = 4
SMOOTHING = 2.0
BEAM = 24  # states of the first search, whose cost bounds the exact one
# Costs in nats: reading a look-alike as a letter, leaving a look-alike out, leaving another
# sign out, merging a letter into an equal one before it (from the third in a row on, and the
# second), ending a word between letters that were set apart; a look-alike in a token without
# letters that is no word (any of them is as likely); joining two pieces to a word.
AS_LETTER, LEFT_OUT, SIGN, REPEAT, SECOND, BORDER = 1.0, 5.0, 0.5, 0.3, 4.0, 2.0
ITSELF, JOIN = float(np.log(len(LOOKALIKES))), 2.0

INDEX = {c: i for i, c in enumerate(LETTERS)}
A = len(LETTERS)
PLAIN = re.compile(f"[{LETTERS[1:]}]+")
COMMON = re.compile(f"([{LETTERS[1:]}]+)[.,;:?]*")
DOUBLE = re.compile(r"(.)\1")
SIGNS = re.escape("".join(c for c in LOOKALIKES if not c.isdigit()))
# Signs at the ends of a word are punctuation, but for one or two that may be letters.
ENDS = re.compile(rf"^(?:[^\w{SIGNS}]|([{SIGNS}])\1\1+)+|(?:[^\w{SIGNS}]|!|([{SIGNS}])\2\2+)+$")


def ngram_counts(words: Counter) -> Counter:
    """Counts of letter n-grams (as numbers in base A) inside bordered words of letters."""
    plain = [w for w in words if PLAIN.fullmatch(w)]
    if not plain:
        return Counter()
    pad = " " * (ORDER - 1)
    text = "".join(pad + w + " " for w in plain)
    sizes = np.fromiter((len(w) + 1 for w in plain), np.int64, len(plain))
    codes = np.fromiter(map(INDEX.__getitem__, text), np.int64, len(text))
    weights = np.repeat(np.fromiter((words[w] for w in plain), np.int64, len(plain)), sizes)
    ends = np.cumsum(sizes + ORDER - 1)
    stops = np.repeat(ends - sizes, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    grams = np.zeros(len(stops), np.int64)
    for k in range(ORDER):
        grams = grams * A + codes[stops - (ORDER - 1) + k]
    found, inverse = np.unique(grams, return_inverse=True)
    return Counter(dict(zip(found.tolist(), np.bincount(inverse, weights).astype(np.int64).tolist())))


def char_model(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Costs ``-log p(letter | three before it)`` as float32 [A, A, A, A], smoothed downwards."""
    dense = np.zeros(A**ORDER)
    dense[grams] = counts
    dense = dense.reshape((A,) * ORDER)
    p = np.full(A, 1 / A)
    for order in range(1, ORDER + 1):
        c = dense.sum(axis=tuple(range(ORDER - order))) if order < ORDER else dense
        p = (c + SMOOTHING * p) / (c.sum(-1, keepdims=True) + SMOOTHING)
    return -np.log(p).astype(np.float32)


class Restorer:
    """Finds the likeliest words behind disguised ones; plain words are their own restoration."""

    def __init__(self, model: np.ndarray):
        self.cost = model
        self.flat = memoryview(np.ascontiguousarray(model).reshape(-1))  # gives numbers without arrays around them

    def words(self, token: str) -> list[str]:
        """The words behind one lower-case token (none if it is no word)."""
        if common := COMMON.fullmatch(token):  # nearly all words
            core = common[1]
            return self.decode(core) if DOUBLE.search(core) else [core]
        core = ENDS.sub("", token)
        if not any(c in INDEX for c in core):
            return self.signs(core)
        if PLAIN.fullmatch(core) and not DOUBLE.search(core):
            return [core]
        return self.decode(core)

    def signs(self, text: str, spaced: bool = False) -> list[str]:
        """The words behind signs without a letter, if they cost less than the signs themselves."""
        if not any(c in LOOKALIKES for c in text):
            return []
        return self._search(text, spaced, sum(ITSELF if c in LOOKALIKES else SIGN for c in text))[1].split()

    def decode(self, text: str, spaced: bool = False) -> list[str]:
        """Viterbi search (over the last three letters) through the lattice of ``text``.

        ``spaced`` texts are single signs that stood apart; words may end between any two.
        """
        cost, out, cut = self._search(text, spaced, np.inf, BEAM)
        return (self._search(text, spaced, cost + 1e-9)[1] if cut else out).split()

    def _search(self, text: str, spaced: bool, limit: float, beam_size: int | None = None) -> tuple[float, str, bool]:
        """The least cost under ``limit``, its words (none if there are no such), and whether states
        beyond ``beam_size`` were left. No cost is negative, so that states which cannot end under the
        limit go without a change of the result: a beam's cost is a limit for the exact search."""
        flat, last, two = self.flat, A, A * A
        h, before, start, n = 0, "", 0.0, 0
        if limit == np.inf and not spaced:  # one way only, up to a sign that is no letter or comes again
            for c in text:
                i = INDEX.get(c, -1)
                if i < 0 or c == before:
                    break
                start += flat[h * last + i]
                h, before, n = h % two * last + i, c, n + 1
        first, text = text[:n], text[n:]
        least = [0.0 if c in INDEX else min(AS_LETTER, LEFT_OUT) if c in LOOKALIKES else SIGN for c in text]
        rest, cut = sum(least), False
        # history (the last three letters as a number in base A, 0 at the start) -> (cost, letters so far)
        beam = {h: (start, first)}
        run = 1

        def offer(key, cost, out):
            if cost < most and (key not in step or (cost, out) < step[key]):
                step[key] = (cost, out)

        for sign, floor in zip(text, least):
            run = run + 1 if sign == before else 1
            before = sign
            rest -= floor
            most = limit - rest
            step: dict[int, tuple[float, str]] = {}
            again = REPEAT if run > 2 else SECOND
            if sign in INDEX and not spaced:  # nearly all signs of nearly all words
                i = INDEX[sign]
                for h, (cost, out) in beam.items():
                    if run > 1 and h % last == i:
                        offer(h, cost + again, out)
                    key, new = h % two * last + i, cost + flat[h * last + i]
                    if key in step:
                        offer(key, new, out + sign)
                    elif new < most:
                        step[key] = (new, out + sign)
            else:
                options = [(sign, 0.0)] if sign in INDEX else [(c, AS_LETTER) for c in LOOKALIKES.get(sign, "")]
                for h, (cost, out) in beam.items():
                    if sign not in INDEX:
                        offer(h, cost + (LEFT_OUT if sign in LOOKALIKES else SIGN), out)
                    for c, extra in options:
                        i = INDEX[c]
                        if run > 1 and h % last == i:
                            offer(h, cost + extra + again, out)
                        offer(h % two * last + i, cost + extra + flat[h * last + i], out + c)
                        if spaced and h:
                            ended = cost + extra + flat[h * last] + BORDER
                            offer(i, ended + flat[i], out + " " + c)
            beam = step
            if beam_size and len(step) > beam_size:
                beam, cut = dict(sorted(step.items(), key=lambda x: x[1])[:beam_size]), True
        ends = ((cost + flat[h * last], out) for h, (cost, out) in beam.items())
        return (*min((x for x in ends if x[0] < limit), default=(limit, "")), cut)

    def outline(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Of words of letters: the last three letters, and the first three with the end of a shorter word
        (-1 where there is no more); the cost of the end, and that of the beginning."""
        letters = np.full((len(words), 6), -1, np.int8)
        costs = np.zeros((len(words), 2), np.float32)
        for k, w in enumerate(words):
            codes = [INDEX[c] for c in w]
            padded = [0, 0, 0, *codes, 0]
            first = padded[3:6]
            letters[k, :3] = padded[-4:-1]
            letters[k, 3:3 + len(first)] = first
            costs[k, 0] = self.cost[tuple(padded[-4:])]
            costs[k, 1] = sum(float(self.cost[tuple(padded[j:j + 4])]) for j in range(len(first)))
        return letters, costs

    def joins(self, letters: np.ndarray, costs: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the words at ``a`` cost less when those at ``b`` go on with them, than apart."""
        h = [letters[a, k].astype(np.int64) for k in range(3)]
        joined = np.full(len(a), JOIN, np.float32)
        for k in range(3, 6):
            c = letters[b, k].astype(np.int64)
            joined += np.where(c >= 0, self.cost[h[0], h[1], h[2], np.maximum(c, 0)], 0)
            h = [h[1], h[2], np.maximum(c, 0)]
        return joined < costs[a, 0] + costs[b, 1]
