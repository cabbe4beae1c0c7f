"""Plain single-process versions of what the operators compute, and hard little tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

# names that operators use for their own columns
CLASHES = ("n_words", "kept", "score", "words", "lines", "mix", "start", "slot", "row", "key", "bucket", "plan", "component_id",
           "band", "u", "v", "n_shingles", "bands", "held_out", "ids", "part", "shard", "spans", "block", "first_id", "place", "text_hash",
           "s_id", "starts", "label", "chars", "head", "units", "Doc_Hash")

PASSAGE = "one line that many documents share word for word\nand a second line that follows it every time\nthen a third line closes the shared passage here"
LONG = " ".join(f"word{k % 977} idiot the of" for k in range(30_000))

HARD_ROWS = [
    (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, "   \n \t ", None, None, 7), (4, "one two", "en", "b", 7),
    (5, "one two", "en", "b", 7), (5, "one two", "en", "b", 7), (6, "another text with the same id", "en", "b", 1),
    (6, "a different text with the same id as before", "en", None, 1), (None, "no id here", "en", "c", 1), (None, None, None, None, None),
    (None, PASSAGE, "en", "c", 1), (7, PASSAGE + "\nand an end of its own", "en", "a", 1), (8, "a start of its own\n" + PASSAGE, "en", "a", 1),
    (9, "\n\n\n\n\n", "en", "a", 5), (10, LONG, "en", "hot", len(LONG)), (11, "x" * 50_000, "en", "hot", 1),
    (12, "naïve café Ünïcödé 日本語 \U0001F600 <|endoftext|> don't 1d10t m0r0n", "fr", "hot", 1),
    (13, "i d i o t and bob.57@mail2.example.com +1 (826) 555-4081 190.137.2.3 4111 1111 1111 1111", "en", "hot", 1),
    (14, "\n".join(["same line here"] * 9), "en", "hot", 1), (-15, "\x1c\x85\xa0odd spaces\x0bhere\x0c", "en", "", 1),
]


def hard_documents(spark, rows=None, clashes: bool = True):
    df = spark.createDataFrame(HARD_ROWS if rows is None else rows, DOCUMENTS)
    if clashes:
        from pyspark.sql import functions as F
        df = df.select("*", *(F.lit(k).alias(c) for k, c in enumerate(CLASHES)))
    return df


def words(text):
    return (text or "").encode().lower().split()


def shingles(text) -> frozenset:
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


class Groups:
    def __init__(self):
        self.parent = {}

    def find(self, x):
        while (up := self.parent.setdefault(x, x)) != x:
            self.parent[x] = self.parent[up]
            x = up
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def near_duplicates(rows) -> dict:
    """doc_id -> component of (doc_id, text) rows without null ids."""
    sets = [(i, shingles(t)) for i, t in rows]
    owners: dict = {}
    for k, (_, s) in enumerate(sets):
        for x in s:
            owners.setdefault(x, []).append(k)
    g = Groups()
    for k, (i, s) in enumerate(sets):
        g.find(i)
        for j, n in Counter(j for x in s for j in owners[x] if j > k).items():
            if 100 * n >= 75 * (len(s) + len(sets[j][1]) - n):
                g.join(i, sets[j][0])
    return {i: g.find(i) for i, _ in rows}


def line_dedup(rows) -> list:
    """Texts of (doc_id, text) rows after removal; rows equal in both count once. Rows must be in
    the order of occurrence."""
    seen: dict = {}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        gone = set()
        for k in range(len(lines) - 2):
            w = tuple(lines[k:k + 3])
            if any(x.encode().split() for x in w) and seen.setdefault(w, (i, text, k)) != (i, text, k):
                gone |= {k, k + 1, k + 2}
        out.append(text if not gone else "\n".join(x for k, x in enumerate(lines) if k not in gone))
    return out


def base_lm(rows) -> dict:
    """doc_id -> (held_out, n_tokens, n_known, train_tokens, base_score)."""
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    c: Counter = Counter()
    for i, t in rows:
        if not held(i):
            c.update([*words(t), None])
    n, v = sum(c.values()), len(c)
    out = {}
    for i, t in rows:
        tokens = [*words(t), None]
        out[i] = (held(i), len(tokens), sum(c[w] > 0 for w in tokens), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens))
    return out


def interpolated_lm(rows) -> dict:
    """doc_id -> log10 p of the text under the smoothed bigrams of op9, counted over all rows."""
    texts = {i: [b"", *words(t), None] for i, t in rows}
    train = [t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 5 != 1]
    c = Counter(w for t in train for w in t[1:])
    pairs = Counter(p for t in train for p in zip(t, t[1:]))
    follow = Counter()
    for (v, _), k in pairs.items():
        follow[v] += k
    once, every = Counter(), Counter()
    for (v, _), k in pairs.items():
        once[follow[v].bit_length()] += k == 1
        every[follow[v].bit_length()] += k
    n = sum(c.values())
    rare = min(max((sum(k == 1 for k in c.values()) + 0.5) / (n + 1), 1e-4), 1 - 1e-4)

    def p(v, w):
        q = (1 - rare) * c[w] / n if c[w] else rare / (len(c) + 1)
        if not follow[v]:
            return q
        order = follow[v].bit_length()
        b = min(max((once[order] + 0.5) / (every[order] + 1), 1e-4), 1 - 1e-4)
        return (1 - b) * pairs[v, w] / follow[v] + b * q

    return {i: sum(math.log10(p(v, w)) for v, w in zip(t, t[1:])) for i, t in texts.items()}


def luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def base_pii(text) -> list:
    """(start, kind, end) by the patterns as they are stated."""
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[ -]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def mix_places(rows, units=1000, block_chars=65_536) -> dict:
    """doc_id -> (slot, start) of (doc_id, source, text) rows, by running the schedule slot by slot."""
    streams: dict = {}
    for i, source, text in sorted(rows, key=lambda r: hashlib.md5(str(r[0]).encode()).hexdigest()):
        streams.setdefault(source, []).append((i, len(text or "")))
    sources = sorted(streams, key=lambda s: (s is not None, s or ""))
    roots = [math.isqrt(sum(n for _, n in streams[s])) for s in sources]
    share = [max(r * units // max(sum(roots), 1), 1) for r in roots]
    blocks = [sum(n for _, n in streams[s]) // block_chars + 1 for s in sources]
    period, done, slots = sum(share), [0] * len(sources), [[] for _ in sources]
    slot = 0
    while any(len(x) < n for x, n in zip(slots, blocks)):
        ready = [(-(-(k + 1) * period // a), j) for j, (k, a) in enumerate(zip(done, share)) if k * period // a <= slot]
        if ready:
            j = min(ready)[1]
            slots[j].append(slot)
            done[j] += 1
        slot += 1
    out = {}
    for j, s in enumerate(sources):
        start = 0
        for i, n in streams[s]:
            out[i] = (slots[j][start // block_chars], start)
            start += n
    return out


def bpe_digests(text, tokenizer) -> tuple:
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(",".join(map(str, ids))), sha(tokenizer.decode(ids, skip_special_tokens=False))


def damaged(rows) -> dict:
    """conv_id -> rows (turn, role, text) after damage in order, of (conv_id, turn, role, text) rows."""
    out: dict = {}
    blank = lambda v: " " if v is None else str(v)
    for conv, turn, role, text in rows:
        here = out.setdefault(conv, [])
        kind = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        role, text = blank(role), blank(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        here += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    for here in out.values():
        here.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


GOOD = re.compile(r"(s?(ua)+)?")
BEGUN = re.compile(r"(s|s?(ua)*u?)?")


def repairs(rows, faults, every=True):
    """Every sensible repair of (role, text) rows as (cost, audit, repaired lines), one row after another;
    or, of repairs that made the same roles of the rows so far, the best only."""
    found = {("", ""): (0, ())}  # (initials so far, audit so far) -> cost, lines

    def step(found, ways):
        out: dict = {}
        for (initials, audit), (cost, lines) in found.items():
            for more, letter, price, line in ways:
                if BEGUN.fullmatch(initials + more):
                    out[initials + more, audit + letter] = (cost + price, lines + line)
        return out

    def inserted(found):
        once = step(found, [(n[0], "I", 2, (n + ":",)) for n in ("user", "assistant")])
        return found | once | step(once, [(n[0], "I", 2, (n + ":",)) for n in ("user", "assistant")])

    for (role, text), fault in zip(rows, faults):
        ways = [("", "D", 3, ())]
        if fault not in ("blank", "duplicate"):
            cut = fault == "truncated"
            ways += [(n[0], "R", 2 + cut, (f"{n}:{text}",)) for n in ("user", "assistant")]
            if role[:1] in ("s", "u", "a"):
                ways.append((role[:1], "K", cut, (f"{role}:{text}",)))
        found = step(inserted(found), ways)
        if not every:
            best: dict = {}
            for (initials, audit), (cost, lines) in found.items():
                best[initials] = min(best.get(initials, (cost, audit, lines)), (cost, audit, lines))
            found = {(initials, audit): (cost, lines) for initials, (cost, audit, lines) in best.items()}
    return [(cost, audit, lines) for (initials, audit), (cost, lines) in (inserted(found) if rows else found).items() if GOOD.fullmatch(initials)]


def faults(rows) -> list:
    seen, out = set(), []
    for role, text in rows:
        end = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def repaired(rows) -> dict:
    """conv_id -> gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    out = {}
    for conv, found in damaged(rows).items():
        pairs = [r[1:] for r in found]
        kinds = faults(pairs)
        turns = [r[0] for r in found if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        bad = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
        cost, audit, lines = min(repairs(pairs, kinds, every=False))
        out[conv] = (gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), bad, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out
