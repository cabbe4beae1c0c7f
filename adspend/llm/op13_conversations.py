"""Operator 13: repair of damaged conversations by Hirschberg's divide and conquer.

The roles of a good conversation are ``(s?(ua)+)?``, read by an automaton of four states. A row is
kept, given the role user or assistant, or deleted; empty rows may be put in anywhere. For each
pair of states a row has one least cost of leading from the one to the other, and among the edits
of that cost the one whose letters come first. To find the whole path, the costs of the first half
from the start and of the second half to the end are carried as vectors of four states; where they
meet, the least sum tells the state in the middle, and both halves are solved alone. Nothing but
the two vectors is held meanwhile.

Ties: a vector also ranks its states by the letters that lead to them. Inserted rows count to the
row after them, so letters up to a row's end never are the beginning of others that end there, and
the one with the better rank at the crossing is the better one whatever follows.

On Spark the rows are dealt by ranges of (conversation, turn, ...), so that one conversation may
lie in many tasks. A conversation that lies inside a task is repaired there. Of one that may go on
in the next task, or has more than ``BLOCK_ROWS`` rows, each block gives its costs between all
pairs of states: to its conversation the block is one step, like a row. The same divide and
conquer over blocks finds the states at their borders, then each block is rebuilt alone. What one
conversation brings to one task is a summary of some 40 numbers for each block, and at the end its
letters and, as a stream, its repaired text, which the digest needs in order.

Results: every conv_id of the input gives one row, null too. Nulls of role and text are one space,
and so are those of conv_id and turn in the sum that chooses the damage. Rows are in the order of
turn (null first), then role, then text; equal rows are repeats of each other. Other columns of the
input are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adspend.llm.common import per_worker, written

BLOCK_ROWS = 4096
BLOCK_CHARS = 4 << 20
WHITE = " \t\n\x0b\x0c\r"
FAR = 1 << 40
STATES = range(4)  # nothing yet, after the system row, after user, after assistant
AFTER = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
TURN = (2, 2, 3, 2)  # the state after a row with the role that fits, other than system
ENDINGS = ("", "II", "I", "")
END = (0, 4, 2, 0)
NAMES = {2: "user", 3: "assistant"}
GONE = 0  # code of a row that must be deleted


def code(initial: str, truncated: bool) -> int:
    return 1 + 2 * "sua".find(initial) + truncated if initial and initial in "sua" else 7 + truncated


def edits(row: int) -> list[list[tuple[int, str]]]:
    """Cost and letters of the best edit of a row between each pair of states."""
    role, truncated = "-" if row in (GONE, 7, 8) else "sua"[(row - 1) // 2], row and (row - 1) % 2
    best = [[(FAR, "")] * 4 for _ in STATES]
    for start in STATES:
        at = start
        for inserted in range(3):
            ways = [(at, 3, "D")]
            if row != GONE:
                ways.append((TURN[at], 2 + truncated, "R"))
                if role in AFTER[at]:
                    ways.append((AFTER[at][role], truncated, "K"))
            for to, cost, letter in ways:
                best[start][to] = min(best[start][to], (2 * inserted + cost, "I" * inserted + letter))
            at = TURN[at]
    return best


EDITS = [edits(row) for row in range(9)]


def ranked(keys: list) -> tuple[int, ...]:
    order = sorted(keys)
    return tuple(order.index(k) for k in keys)


# a step: the costs between all pairs of states, and for each first state the ranks of the letters
STEPS = [(tuple(tuple(c for c, _ in e) for e in row), tuple(ranked([w for _, w in e]) for e in row)) for row in EDITS]


def step_of(item) -> tuple:
    return STEPS[item] if isinstance(item, int) else item


def from_state(state: int) -> tuple:
    return tuple(0 if s == state else FAR for s in STATES), (0, 0, 0, 0)


def forward(vector: tuple, item) -> tuple:
    """Costs and ranks of the states after one more step; the least cost is not brought to 0."""
    (costs, ranks), (between, order) = vector, step_of(item)
    found = [min((min(costs[s] + between[s][t], FAR), ranks[s], order[s][t]) for s in STATES) for t in STATES]
    return tuple(f[0] for f in found), ranked([f[1:] for f in found])


def backward(item, costs: tuple) -> tuple:
    between = step_of(item)[0]
    return tuple(min(min(between[s][t] + costs[t] for t in STATES), FAR) for s in STATES)


def lowered(costs: tuple) -> tuple:
    least = min(costs)
    return tuple(c - least if c < FAR else c for c in costs)


def ahead_of(vector: tuple, items) -> tuple:
    """The vector after all items. Less its least cost, a vector over rows is one of few: each is
    taken a row further once in a worker."""
    known = per_worker("conversations ahead", dict)
    for item in items:
        if isinstance(item, int):
            if (found := known.get((vector, item))) is None:
                costs, ranks = forward(vector, item)
                found = known[vector, item] = lowered(costs), ranks
            vector = found
        else:
            vector = forward(vector, item)
    return vector


def behind_of(items, costs: tuple) -> tuple:
    known = per_worker("conversations behind", dict)
    for item in reversed(items):
        if isinstance(item, int):
            if (found := known.get((item, costs))) is None:
                found = known[item, costs] = lowered(backward(item, costs))
            costs = found
        else:
            costs = backward(item, costs)
    return costs


def path(items: list, start: int, end: tuple[int, ...]) -> list[int]:
    """The state after each item, on the way of least cost from ``start``; ``end`` holds what remains
    to be paid in each state at the end. Items are codes of rows, or steps."""
    if not items:
        return []
    if len(items) == 1:
        between, order = step_of(items[0])
        return [min(STATES, key=lambda t: (between[start][t] + end[t], order[start][t]))]
    middle = len(items) // 2
    ahead, behind = ahead_of(from_state(start), items[:middle]), behind_of(items[middle:], end)
    crossing = min(STATES, key=lambda s: (ahead[0][s] + behind[s], ahead[1][s]))
    return path(items[:middle], start, from_state(crossing)[0]) + path(items[middle:], crossing, end)


def path_of_rows(codes: bytes, start: int, end: tuple[int, ...]) -> list[int]:
    """``path`` over rows; that of few rows is remembered."""
    if len(codes) > 32:
        return path(list(codes), start, end)
    known = per_worker("conversations short", dict)
    if len(known) > 20_000:
        known.clear()
    if (found := known.get((codes, start, end))) is None:
        found = known[codes, start, end] = path(list(codes), start, end)
    return found


def block_step(codes: bytes) -> tuple:
    """All rows of a block as one step."""
    found = []
    for start in STATES:
        vector = from_state(start)
        for row in codes:
            vector = forward(vector, row)
        found.append(vector)
    return tuple(c for c, _ in found), tuple(r for _, r in found)


def rebuild(codes: bytes, rows: list, start: int, end: tuple[int, ...], last: bool) -> tuple[str, int, list[str]]:
    """The letters, their cost and the repaired ``role:text`` of rows between two states."""
    states = path_of_rows(codes, start, end)
    letters, cost, out, at = [], 0, [], start
    for k, to in enumerate(states):
        price, word = EDITS[codes[k]][at][to]
        cost += price
        letters.append(word)
        for letter in word:
            if letter == "I":
                at = TURN[at]
                out.append(NAMES[at] + ":")
            elif letter == "R":
                out.append(f"{NAMES[to]}:{rows[k][1]}")
            elif letter == "K":
                out.append(f"{rows[k][0]}:{rows[k][1]}")
        at = to
    if last:
        cost += END[at]
        letters.append(ENDINGS[at])
        for _ in ENDINGS[at]:
            at = TURN[at]
            out.append(NAMES[at] + ":")
    return "".join(letters), cost, out


def illegal(before: str, after: str) -> bool:
    return before + after not in ("su", "ua", "au")


class Block:
    """Rows of one conversation that follow each other, up to ``BLOCK_ROWS``."""

    def __init__(self):
        self.codes, self.rows, self.digests = bytearray(), [], []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = self.chars = 0
        self.first = self.last = ""
        self.first_turn = self.last_turn = None
        self.seen: set[bytes] = set()

    def add(self, turn, role: str, text: str) -> None:
        end = text.rstrip(WHITE)
        digest, row, kind, cut = None, None, GONE, False
        if not end:
            self.blank += 1
        else:
            digest = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
            if digest in self.seen:
                self.duplicate += 1
                digest = None
            else:
                self.seen.add(digest)
                cut = end[-1] not in ".!?"
                self.truncated += cut
                row, kind = (role, text), code(role[:1], cut)
                self.chars += len(text)
        if self.codes:
            self.illegal += illegal(self.last, role[:1])
        else:
            self.first = role[:1]
        self.last = role[:1]
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        self.codes.append(kind)
        self.rows.append(row)
        self.digests.append(digest)

    def full(self) -> bool:
        return len(self.codes) >= BLOCK_ROWS or self.chars >= BLOCK_CHARS


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def result(conv_id: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("conv_id", conv_id), *(T.StructField(c, T.LongType()) for c in COUNTS),
                         T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage with ``copies`` of each; a dropped row has none and holds nothing else."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.encode(F.concat_ws(":", blank("conv_id"), blank("turn")), "UTF-8")) % 20
    rows = conversations.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), kind.alias("kind"))
    here = F.col("kind") != 0
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", F.when(here, F.col("turn")).alias("turn"), F.when(F.col("kind") == 4, "user").when(here, F.col("role")).otherwise("").alias("role"),
                       F.when(here, text).otherwise("").alias("text"), F.when(~here, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("copies"))


def repair(conversations: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``."""
    spark = conversations.sparkSession
    rows = damaged(conversations)
    id_type, turn_type = rows.schema["conv_id"].dataType, rows.schema["turn"].dataType
    number = lambda name: T.StructField(name, T.LongType())
    shape = T.StructType([
        *result(id_type), number("part"), number("block"), T.StructField("codes", T.BinaryType()),
        T.StructField("rows", T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))),
        T.StructField("digests", T.ArrayType(T.BinaryType())), number("turns"), T.StructField("first_turn", turn_type),
        T.StructField("last_turn", turn_type), T.StructField("first", T.StringType()), T.StructField("last", T.StringType())])
    names = shape.names

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, size, blocks = TaskContext.get().partitionId(), [], 0, 0
        schema = None

        def flush(conv, block, alone):
            nonlocal blocks, size
            if alone:
                audit, cost, lines = rebuild(bytes(block.codes), block.rows, 0, END, bool(block.codes))
                gaps = block.last_turn - block.first_turn + 1 - block.turns if block.turns else 0
                sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
                out.append((conv, gaps, block.blank, block.duplicate, block.truncated, block.illegal, cost, audit, sha, *[None] * 10))
                size += len(audit)
            else:
                kept = [None if r is None else {"role": r[0], "text": r[1]} for r in block.rows]
                out.append((conv, 0, block.blank, block.duplicate, block.truncated, block.illegal, 0, None, None, part, blocks, bytes(block.codes), kept,
                            block.digests, block.turns, block.first_turn, block.last_turn, block.first, block.last))
                blocks += 1
                size += block.chars + len(block.codes)

        def ready():
            nonlocal out, size
            table = pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
            out, size = [], 0
            return table

        conv, block, first, whole = None, None, True, True
        for batch in batches:
            if schema is None:
                ids, turns = batch.schema.field("conv_id").type, batch.schema.field("turn").type
                text, long = batch.schema.field("text").type, pa.int64()
                row = pa.struct([pa.field("role", text), pa.field("text", text)])
                schema = pa.schema(list(zip(names, [ids, *[long] * 6, text, text, long, long, pa.binary(), pa.list_(row), pa.list_(pa.binary()), long, turns, turns, text, text])))
            for this, turn, role, text_, copies in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "copies"))):
                if block is None or this != conv:
                    if block is not None:
                        flush(conv, block, whole and not first)
                        first = False
                    conv, block, whole = this, Block(), True
                for _ in range(copies):
                    if block.full():
                        flush(conv, block, False)
                        block, whole = Block(), False
                    block.add(turn, role, text_)
                if size > BLOCK_CHARS or len(out) > 10_000:
                    yield ready()
        if block is not None:
            flush(conv, block, False)
            yield ready()

    order = ["conv_id", "turn", "role", "text"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the ranges go by a beginning of the text, which keeps the sampled bounds small; the order goes by all of it
    ranges = rows.repartitionByRange(parts, "conv_id", "turn", "role", F.substring("text", 1, 40))
    found = written(ranges.sortWithinPartitions(*order).mapInArrow(split, shape), "conversations")
    done = found.where("codes is null").select(*result(id_type).names)
    return done.unionByName(joined(found.where("codes is not null"), id_type))


def joined(blocks: DataFrame, id_type: T.DataType) -> DataFrame:
    """The results of conversations that lie in several blocks."""
    # rows that are first in their block but repeat one of an earlier block of the conversation
    seen = blocks.select("conv_id", "part", "block", F.posexplode("digests").alias("at", "digest")).where("digest is not null")
    place = F.struct("part", "block")
    first = F.min(place).over(Window.partitionBy("conv_id", "digest"))
    late = seen.withColumn("first", first).where(F.col("first") < place).groupBy("part", "block").agg(F.collect_list("at").alias("late"))
    blocks = blocks.join(written(late, "late"), ["part", "block"], "left")
    small = ["conv_id", "part", "block", "first", "last", "first_turn", "last_turn", "turns"]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for codes, late in zip(batch.column("codes").to_pylist(), batch.column("late").to_pylist()):
                now, _ = without(codes, late)
                costs, ranks = block_step(now)
                found.append((len(now), [c for row in costs for c in row], [r for row in ranks for r in row]))
            more = [pa.array([f[k] for f in found], t) for k, t in enumerate((pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())))]
            yield pa.record_batch([*(batch.column(c) for c in small), *more], names=[*small, "n_rows", "costs", "ranks"])

    longs = T.ArrayType(T.LongType())
    summaries = blocks.select(*small, "codes", "late").mapInArrow(sums, T.StructType([
        *blocks.select(*small).schema, T.StructField("n_rows", T.LongType()), T.StructField("costs", longs), T.StructField("ranks", longs)]))

    def borders(group: pa.Table) -> pa.Table:
        square = lambda v: tuple(tuple(v[k:k + 4]) for k in (0, 4, 8, 12))
        group = group.sort_by([("part", "ascending"), ("block", "ascending")]).to_pylist()
        states = path([(square(r["costs"]), square(r["ranks"])) for r in group if r["n_rows"]], 0, END)
        at, taken, before, turn, out = 0, 0, None, None, []
        for r in group:
            start, some = at, r["n_rows"] > 0
            if some:
                at, taken = states[taken], taken + 1
            out.append({"part": r["part"], "block": r["block"], "start": start, "stop": at, "final": some and taken == len(states),
                        "crossing": int(some and before is not None and illegal(before, r["first"])),
                        "same": int(turn is not None and r["first_turn"] == turn)})
            before, turn = r["last"] if some else before, turn if r["last_turn"] is None else r["last_turn"]
        return pa.Table.from_pylist(out, pa.schema([("part", pa.int64()), ("block", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()),
                                                    ("final", pa.bool_()), ("crossing", pa.int64()), ("same", pa.int64())]))

    states = summaries.groupBy("conv_id").applyInArrow(borders, "part long, block long, start long, stop long, final boolean, crossing long, same long")
    held = ["conv_id", "part", "block", "blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn", "crossing", "same"]
    made = T.StructType([T.StructField("audit", T.StringType()), T.StructField("cost", T.LongType()), T.StructField("n_lines", T.LongType()),
                         T.StructField("lines", T.StringType()), T.StructField("repeated", T.LongType()), T.StructField("cut", T.LongType())])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                codes, late, rows, start, stop, final = (one.column(c)[0].as_py() for c in ("codes", "late", "rows", "start", "stop", "final"))
                now, cut = without(codes, late)
                audit, cost, lines = rebuild(now, [r and (r["role"], r["text"]) for r in rows], start, END if final else from_state(stop)[0], final)
                more = (audit, cost, len(lines), "\n".join(lines), len(late or ()), cut)
                yield pa.record_batch([*(one.column(c) for c in held), *(pa.array([v]) for v in more)], names=held + made.names)

    solved = blocks.drop("gaps", "cost", "audit").join(states, ["part", "block"])
    rebuilt = solved.select(*held, "codes", "late", "rows", "start", "stop", "final").mapInArrow(parts, T.StructType([*solved.select(*held).schema, *made]))
    # only the letters and the repaired text of a conversation come together, block by block
    one_by_one = rebuilt.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, total, schema = None, None, None

        def row():
            first, last = total["first_turn"], total["last_turn"]
            gaps = last - first + 1 - total["turns"] if first is not None else 0
            values = (conv, gaps, *(total[c] for c in COUNTS[1:]), "".join(total["audit"]), total["sha"].hexdigest())
            return pa.record_batch([pa.array([v], t) for v, t in zip(values, schema.types)], schema=schema)

        for batch in batches:
            ids, text = batch.schema.field("conv_id").type, batch.schema.field("audit").type
            schema = pa.schema(list(zip(("conv_id", *COUNTS, "audit", "repaired_sha256"), [ids, *[pa.int64()] * 6, text, text])))
            for r in batch.to_pylist():
                if total is None or r["conv_id"] != conv:
                    if total is not None:
                        yield row()
                    conv = r["conv_id"]
                    total = dict.fromkeys((*COUNTS, "turns"), 0) | {"audit": [], "sha": hashlib.sha256(), "first_turn": None, "last_turn": None, "any": False}
                total["blank"] += r["blank"]
                total["duplicate"] += r["duplicate"] + r["repeated"]
                total["truncated"] += r["truncated"] - r["cut"]
                total["illegal"] += r["illegal"] + r["crossing"]
                total["cost"] += r["cost"]
                total["turns"] += r["turns"] - r["same"]
                total["audit"].append(r["audit"])
                if r["first_turn"] is not None:
                    total["first_turn"] = r["first_turn"] if total["first_turn"] is None else total["first_turn"]
                    total["last_turn"] = r["last_turn"]
                if r["n_lines"]:
                    total["sha"].update((("\n" if total["any"] else "") + r["lines"]).encode())
                    total["any"] = True
        if total is not None:
            yield row()

    return one_by_one.mapInArrow(digests, result(id_type))


def without(codes: bytes, late) -> tuple[bytes, int]:
    """The codes with the late repeats among them deleted, and how many of those counted as truncated."""
    now, cut = bytearray(codes), 0
    for at in late if late is not None else ():
        cut += now[at] % 2 == 0
        now[at] = GONE
    return bytes(now), cut
