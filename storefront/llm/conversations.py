"""Operator 12: repair of conversation structure by Hirschberg's divide and conquer.

A conversation's rows are edited so that the initials of its roles read
``(s?(ua)+)?``, at the least cost (``COSTS``); blank and duplicate rows must go.  The
edits' initials in order are the conversation's audit, and of equally cheap audits
the ASCII-least counts.

Four states say what has been written last: nothing, system, user, assistant.  A
string of edits fixes the state it leads to, and of the least strings that consume the
same rows none begins another.  So a forward vector holds for each state the least
cost and the rank of its least audit, a backward vector the least cost to the end,
and the audit-least optimal path crosses the middle in the state of least sum and
then of least rank.  Both halves are solved in the same way, in linear space.

Rows are range-partitioned by conversation and turn.  A conversation that lies inside a
task and is small is solved there.  What is left, the first and the last conversation
of each task and long ones, is *open*: its pieces of one task each are turned into
4 x 4 matrices of costs and ranks, a conversation's crossings of its pieces' ends
follow from these (one small row for each piece), and every piece is solved alone
between its crossings.  So a conversation with a third of all rows is spread over as
many tasks as its rows.  Only its digest, one hash over all of its text, is a stream
through one task, of bounded memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .corpus_io import small_batches, written

KEEP, REROLE, DELETE, INSERT, TRUNCATED = COSTS = (0, 3, 4, 3, 3)
BLANKS = " \t\n\x0b\x0c\r"
NOTHING, SYSTEM, USER, ASSISTANT = STATES = range(4)
#: What an inserted or re-roled row leads to, and its role.
AFTER = (USER, USER, ASSISTANT, USER)
ROLE = ("user", "user", "assistant", "user")
#: Cost and edits that complete a conversation from each state.
CLOSING = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))
INFINITE = 1 << 60
NO_FAULT, BLANK, DUPLICATE, CUT = range(4)
#: Kind of a row that is not there.
ABSENT = -1
#: Rows and bytes of a conversation that a task holds; longer ones go on in pieces.
HELD_ROWS, HELD_BYTES = 4_096, 4 << 20

Vector = tuple[tuple[int, int], ...]  # (cost, rank) of each state


def kind_of(role: str, fault: int) -> int:
    """A row's role initial (s, u, a or other), and whether it must go or is truncated."""
    return max(0, "?sua".find(role[:1] or "?")) | (fault in (BLANK, DUPLICATE)) << 2 | (fault == CUT) << 3


@lru_cache(maxsize=None)
def moves(kind: int) -> tuple[tuple[tuple[int, str], ...], ...]:
    """Least cost and its least edits that consume one row, from each state to each."""
    best = [[(INFINITE, "")] * 4 for _ in STATES]
    if kind == ABSENT:
        for s in STATES:
            best[s][s] = (0, "")
        return tuple(map(tuple, best))
    initial, gone, cut = kind & 3, bool(kind & 4), TRUNCATED * bool(kind & 8)
    for s in STATES:
        at = s
        for inserts in range(3):
            cost, before = INSERT * inserts, "I" * inserts
            ways = [(DELETE, "D", at)]
            if not gone:
                kept = {1: SYSTEM if at == NOTHING else None, 2: USER if at != USER else None,
                        3: ASSISTANT if at == USER else None}.get(initial)
                if kept is not None:
                    ways.append((KEEP + cut, "K", kept))
                ways.append((REROLE + cut, "R", AFTER[at]))
            for more, edit, to in ways:
                best[s][to] = min(best[s][to], (cost + more, before + edit))
            at = AFTER[at]
    return tuple(map(tuple, best))


@lru_cache(maxsize=1 << 16)
def _step(vector: Vector, kind: int) -> tuple[int, Vector]:
    """The forward vector after one more row, less its least cost, and that cost."""
    table, keys = moves(kind), []
    for t in STATES:
        ways = [(vector[s][0] + table[s][t][0], vector[s][1], table[s][t][1])
                for s in STATES if vector[s][0] < INFINITE and table[s][t][0] < INFINITE]
        keys.append(min(ways) if ways else (INFINITE, 0, ""))
    ranks = {k: i for i, k in enumerate(sorted({k[1:] for k in keys if k[0] < INFINITE}))}
    least = min(k[0] for k in keys)
    return least, tuple((k[0] - least, ranks[k[1:]]) if k[0] < INFINITE else (INFINITE, 0) for k in keys)


@lru_cache(maxsize=1 << 16)
def _back(vector: tuple[int, ...], kind: int) -> tuple[int, tuple[int, ...]]:
    """The backward vector before one more row, less its least cost, and that cost."""
    table = moves(kind)
    costs = [min(min(table[s][t][0] + vector[t], INFINITE) for t in STATES) for s in STATES]
    least = min(costs)
    return least, tuple(c - least if c < INFINITE else INFINITE for c in costs)


def forward(kinds, start: int) -> Vector:
    """Cost and audit rank of each state after all rows."""
    vector: Vector = tuple((0 if s == start else INFINITE, 0) for s in STATES)
    total = 0
    for kind in kinds:
        least, vector = _step(vector, kind)
        total += least
    return tuple((c + total if c < INFINITE else INFINITE, r) for c, r in vector)


def backward(kinds, ends: tuple[int, ...]) -> tuple[int, ...]:
    """Least cost from each state before the rows to their end, where state t costs ``ends[t]``."""
    total = 0
    for kind in reversed(kinds):
        least, ends = _back(ends, kind)
        total += least
    return tuple(c + total if c < INFINITE else INFINITE for c in ends)


def crossing(left: Vector, right: tuple[int, ...]) -> int:
    """The state in which the audit-least of the cheapest paths crosses."""
    return min(STATES, key=lambda s: (min(left[s][0] + right[s], INFINITE), left[s][1]))


def solve(kinds, start: int, end: int | None) -> tuple[list[str], list[int]]:
    """Edits of each row and the state before them, from ``start`` to ``end`` (None: a complete conversation)."""
    n = len(kinds)
    edits, states = [""] * n, [start] * n
    last = end
    if end is None:
        last = crossing(forward(kinds, start), tuple(c for c, _ in CLOSING))
    todo = [(0, n, start, last)] if n else []
    while todo:
        low, high, p, q = todo.pop()
        if high - low == 1:
            edits[low], states[low] = moves(kinds[low])[p][q][1], p
            continue
        middle = (low + high) // 2
        only = tuple(0 if t == q else INFINITE for t in STATES)
        c = crossing(forward(kinds[low:middle], p), backward(kinds[middle:high], only))
        todo += [(low, middle, p, c), (middle, high, c, q)]
    if end is None and n:
        edits[-1] += CLOSING[last][1]
    return edits, states


def expand(edits: str, state: int, role: str, text: str) -> Iterator[tuple[str, str | None, str | None]]:
    """Each edit with the role and text that it writes; a deletion writes none."""
    for edit in edits:
        if edit == "D":
            yield edit, None, None
        elif edit == "K":
            yield edit, role, text
            state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
        else:
            yield edit, ROLE[state], "" if edit == "I" else text
            state = AFTER[state]


class Digest:
    """Counts, audit and hash of one conversation, row by row."""

    FIELDS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"

    def __init__(self) -> None:
        self.turns, self.first, self.last = 0, None, None
        self.faults = [0, 0, 0, 0]
        self.illegal, self.cost, self.before = 0, 0, None
        self.audit: list[str] = []
        self.sha, self.any = hashlib.sha256(), False

    def add(self, turn: int | None, role: str, text: str, fault: int, edits: str, state: int) -> None:
        if turn is not None and (self.turns == 0 or turn != self.last):
            self.turns += 1
            self.first = turn if self.first is None else self.first
            self.last = turn
        self.faults[fault] += 1
        if self.before is not None:
            self.illegal += self.before + role[:1] not in ("su", "ua", "au")
        self.before = role[:1]
        for edit, new_role, new_text in expand(edits, state, role, text):
            self.audit.append(edit)
            self.cost += {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[edit]
            self.cost += TRUNCATED if fault == CUT and edit in "KR" else 0
            if new_role is not None:
                self.sha.update(("\n" * self.any + new_role + ":" + new_text).encode("utf-8", "surrogatepass"))
                self.any = True

    def result(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return (gaps, *self.faults[1:], self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest())


# --- rows -----------------------------------------------------------------------------------------

def damage(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Plant faults by crc32 of ``conv:turn`` modulo 20: ``conv, turn, role, text, present``.

    0 drops the row (``present`` is false), 1 empties its text, 2 removes the text's
    ``. ! ?``, 3 repeats the row, 4 sets its role to user.  A null counts as one space,
    but a null turn stays null as a turn.
    """
    def filled(c: str) -> F.Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(filled(conv_col), F.lit(":"), filled(turn_col)).cast("binary")) % 20
    text = F.when(fate == 1, F.lit("")).when(fate == 2, F.translate(filled(text_col), ".!?", "")).otherwise(filled(text_col))
    rows = df.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                     F.when(fate == 4, F.lit("user")).otherwise(filled(role_col)).alias("role"), text.alias("text"),
                     (fate != 0).alias("present"), F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"))
    return rows.withColumn("copy", F.explode("copies")).drop("copies", "copy")


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows with their own faults, range-partitioned and sorted by conversation and turn."""
    solid = F.rtrim(F.col("text"), F.lit(BLANKS))
    rows = rows.select(
        "conv", F.when(F.col("conv").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("conv").cast("string"))).alias("name"),
        "turn", "role", "text", "present", (solid == "").alias("void"), (~F.right(solid, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")).alias("same"))
    key = ["name", "turn", "role", "same", "row"]
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(tasks, *key).sortWithinPartitions(*key).drop("row")


ROW = ["conv", "name", "turn", "role", "text", "present", "void", "cut", "same"]


def _first_pass(rows: DataFrame, digest: bool) -> DataFrame:
    """Open rows with their place (``part, pos``), and the digests or edits of all other conversations (``open`` false)."""
    extra = [f.split() for f in (Digest.FIELDS if digest else "fault int, edits string, state int").split(", ")]
    schema = T.StructType([T.StructField("open", T.BooleanType()), T.StructField("part", T.IntegerType()), T.StructField("pos", T.LongType()),
                           *(T.StructField(c, rows.schema[c].dataType) for c in ROW),
                           *(T.StructField(n, {"long": T.LongType(), "int": T.IntegerType(), "string": T.StringType()}[t]) for n, t in extra)])
    arrow = to_arrow_schema(schema)
    none = (None,) * len(extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        out: list[tuple] = []
        held: list[tuple] = []
        size, name, first, spilled = 0, None, True, False

        def closed() -> None:
            """Solve the held conversation."""
            seen: set[str] = set()
            kinds, faults, live = [], [], [h for h in held if h[2][5]]
            for _, _, r in live:
                fault = BLANK if r[6] else DUPLICATE if r[8] in seen else CUT if r[7] else NO_FAULT
                seen.add(r[8])
                faults.append(fault)
                kinds.append(kind_of(r[3], fault))
            edits, states = solve(kinds, NOTHING, None)
            if digest:
                d = Digest()
                for (_, _, r), f, e, s in zip(live, faults, edits, states, strict=True):
                    d.add(r[2], r[3], r[4], f, e, s)
                out.append((False, part, held[0][1], *held[0][2][:2], *(None,) * 7, *d.result()))
            else:
                out.extend((False, p, at, *r, f, e, s) for (p, at, r), f, e, s in zip(live, faults, edits, states, strict=True))

        def opened() -> None:
            out.extend((True, p, at, *r, *none) for p, at, r in held)

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [()] * len(schema)
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)
            out.clear()
            return made

        pos = 0
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ROW), strict=True):
                if row[1] != name:
                    if held:
                        opened() if first or spilled else closed()
                    first = name is None
                    name, held, size, spilled = row[1], [], 0, False
                held.append((part, pos, row))
                size += len(row[4])
                pos += 1
                if len(held) >= HELD_ROWS or size >= HELD_BYTES:
                    opened()
                    held, size, spilled = [], 0, True
                if len(out) >= 1_000:
                    yield batch()
        if held:
            opened()  # the task's last conversation may go on in the next one
        yield batch()

    return rows.select(*ROW).mapInArrow(run, schema)


def _by_piece(df: DataFrame) -> DataFrame:
    return df.repartition("part", "name").sortWithinPartitions("part", "name", "pos")


def _runs(batches: Iterator[pa.RecordBatch], key: list[str], columns: list[str]) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Consecutive rows with equal ``key`` and their ``columns``; one row is held at a time."""
    from itertools import groupby

    def rows() -> Iterator[tuple[tuple, tuple]]:
        for b in batches:
            yield from zip(zip(*(b.column(c).to_pylist() for c in key), strict=True),
                           zip(*(b.column(c).to_pylist() for c in columns), strict=True), strict=True)

    for k, group in groupby(rows(), key=lambda r: r[0]):
        yield k, (r[1] for r in group)


def _solve_open(open_rows: DataFrame) -> DataFrame:
    """``part, pos, fault, edits, state`` of open rows."""
    live = open_rows.filter("present").select("name", "part", "pos", "same")
    # the first of equal rows: within each piece, then among its pieces
    firsts = live.groupBy("name", "part", "same").agg(F.min("pos").alias("pos"))
    heads = firsts.groupBy("name", "same").agg(F.min("part").alias("part"))
    heads = firsts.join(heads, ["name", "same", "part"]).select("part", "pos", F.lit(True).alias("head"))
    facts = open_rows.select("name", "part", "pos", "role", "present", "void", "cut").join(heads, ["part", "pos"], "left")
    facts = facts.select("name", "part", "pos", F.substring("role", 1, 1).alias("role"), F.when(~F.col("present"), F.lit(ABSENT))
                         .when(F.col("void"), F.lit(BLANK)).when(F.col("head").isNull(), F.lit(DUPLICATE))
                         .when(F.col("cut"), F.lit(CUT)).otherwise(F.lit(NO_FAULT)).alias("fault"))
    facts = written(facts, "conversation-facts")

    def kinds_of(rows: Iterator[tuple]) -> Iterator[int]:
        return (ABSENT if fault == ABSENT else kind_of(role, fault) for role, fault in rows)

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (part, name), rows in _runs(batches, ["part", "name"], ["role", "fault"]):
            vectors = [tuple((0 if s == p else INFINITE, 0) for s in STATES) for p in STATES]
            totals = [0] * 4
            for kind in kinds_of(rows):
                for p in STATES:
                    least, vectors[p] = _step(vectors[p], kind)
                    totals[p] += least
            cost = [min(c + totals[p], INFINITE) for p in STATES for c, _ in vectors[p]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([part], pa.int32()), pa.array([cost], pa.list_(pa.int64())),
                 pa.array([[r for v in vectors for _, r in v]], pa.list_(pa.int64()))], names=["name", "part", "cost", "rank"])

    def crossings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (name,), rows in _runs(batches, ["name"], ["part", "cost", "rank"]):
            pieces = list(rows)  # one for each task at most
            ends = tuple(c for c, _ in CLOSING)
            after = [ends, *accumulate(
                (p[1] for p in reversed(pieces)), lambda to, m: tuple(min(min(m[4 * s + t] + to[t], INFINITE) for t in STATES) for s in STATES),
                initial=ends)][1:]
            state = NOTHING
            for i, (part, cost, rank) in enumerate(pieces):
                q = crossing(tuple(zip(cost[4 * state:4 * state + 4], rank[4 * state:4 * state + 4], strict=True)), after[len(pieces) - 1 - i])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([part], pa.int32()), pa.array([state], pa.int32()), pa.array([q], pa.int32()),
                     pa.array([i == len(pieces) - 1])], names=["name", "part", "start", "end", "last"])
                state = q

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (part, _, start, end, last), rows in _runs(batches, ["part", "name", "start", "end", "last"], ["pos", "role", "fault"]):
            pos, fault, kinds = [], [], bytearray()
            for at, role, f in rows:
                if f != ABSENT:
                    pos.append(at)
                    fault.append(f)
                    kinds.append(kind_of(role, f))
            edits, states = solve(kinds, start, end)
            if last and edits:
                edits[-1] += CLOSING[end][1]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(pos), pa.int32()), pa.array(pos, pa.int64()), pa.array(fault, pa.int32()),
                 pa.array(edits, pa.string()), pa.array(states, pa.int32())], names=["part", "pos", "fault", "edits", "state"])

    summed = _by_piece(facts).mapInArrow(matrices, "name string, part int, cost array<long>, rank array<long>")
    crossed = (summed.repartition("name").sortWithinPartitions("name", "part")
               .mapInArrow(crossings, "name string, part int, start int, end int, last boolean"))
    crossed = written(crossed, "conversation-crossings")
    # closing edits belong to the last row that is there: the last piece with one
    alive = facts.filter(F.col("fault") != ABSENT).groupBy("name").agg(F.max("part").alias("closes"))
    crossed = crossed.join(alive, "name").withColumn("last", F.col("part") == F.col("closes")).drop("closes")
    return _by_piece(facts.join(crossed, ["name", "part"])).mapInArrow(edit, "part int, pos long, fault int, edits string, state int")


def _passes(rows: DataFrame, digest: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What the first pass wrote, its open rows, and their edits."""
    small_batches(rows.sparkSession)
    one = written(_first_pass(_ordered(rows), digest), "conversation-pass")
    open_rows = one.filter("open").select("part", "pos", *ROW)
    return one, open_rows, _solve_open(open_rows)


def repair(rows: DataFrame) -> DataFrame:
    """The edits of all conversations: ``conv, part, pos, nth, edit, fault, turn, role, text, new_role, new_text``.

    ``rows`` are ``conv, turn, role, text, present``.  ``part, pos, nth`` put a
    conversation's edits in order.  A deletion has no new role and text, an insertion
    none of the row's own.  Null roles and texts count as one space; a null
    conversation is one of its own; a null turn comes first; rows of one turn are in
    order of their role and a hash of their text; repeated rows are duplicates; a row
    with ``present`` false is not there.  An empty role has no legal initial.  An
    empty table gives an empty result.
    """
    rows = rows.withColumn("role", F.coalesce("role", F.lit(" "))).withColumn("text", F.coalesce("text", F.lit(" ")))
    one, open_rows, solved = _passes(rows, digest=False)
    columns = ["conv", "part", "pos", "turn", "role", "text", "fault", "edits", "state"]
    every = one.filter("not open").select(*columns).unionByName(open_rows.join(solved, ["part", "pos"]).select(*columns))
    schema = T.StructType([T.StructField("conv", every.schema["conv"].dataType), T.StructField("part", T.IntegerType()), T.StructField("pos", T.LongType()),
                           T.StructField("nth", T.IntegerType()), T.StructField("edit", T.StringType()), T.StructField("fault", T.IntegerType()),
                           T.StructField("turn", T.LongType()), *(T.StructField(c, T.StringType()) for c in ("role", "text", "new_role", "new_text"))])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for conv, part, pos, turn, role, text, fault, edits, state in zip(*(b.column(c).to_pylist() for c in columns), strict=True):
                for nth, (edit, new_role, new_text) in enumerate(expand(edits, state, role, text)):
                    own = (fault, turn, role, text) if edit != "I" else (None,) * 4
                    out.append((conv, part, pos, nth, edit, *own, new_role, new_text))
            cols = list(zip(*out, strict=True)) if out else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    return every.select(*columns).mapInArrow(run, schema)


def digests(rows: DataFrame) -> DataFrame:
    """One row for each conversation of ``rows`` (see ``repair``): ``conv`` and ``Digest.FIELDS``.

    A conversation without rows has zeros, an empty audit and the hash of the empty
    string.
    """
    rows = rows.withColumn("role", F.coalesce("role", F.lit(" "))).withColumn("text", F.coalesce("text", F.lit(" ")))
    one, open_rows, solved = _passes(rows, digest=True)
    names = [f.split()[0] for f in Digest.FIELDS.split(", ")]
    done = one.filter("not open").select("conv", *names)
    joined = open_rows.join(solved, ["part", "pos"], "left")
    schema = T.StructType([T.StructField("conv", rows.schema["conv"].dataType), *(one.schema[n] for n in names)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (conv, _), group in _runs(batches, ["conv", "name"], ["present", "turn", "role", "text", "fault", "edits", "state"]):
            d = Digest()
            for present, *row in group:
                if present:
                    d.add(*row)
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((conv, *d.result()), arrow, strict=True)], schema=arrow)

    streamed = joined.repartition("name").sortWithinPartitions("name", "part", "pos").mapInArrow(run, schema)
    return done.unionByName(streamed)
