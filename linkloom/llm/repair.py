"""Conversation structure repair: bidirectional Dijkstra over the edit lattice of each run of turns."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.session import materialize

#: Turns of one segment; longer conversations are solved segment by segment and put together.
SEGMENT = 512
#: What an output may end in so far: nothing, a system turn, a user turn, an assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
ENDS = (NOTHING, ASSISTANT)
RETELL = INSERT = 2
DELETE = 3
#: State before and initial of the next turn to the state after it; nothing else is legal.
STEP = {
    (NOTHING, "s"): SYSTEM,
    (NOTHING, "u"): USER,
    (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT,
    (ASSISTANT, "u"): USER,
}
#: The one turn that may be inserted, or told anew, in a state; a system turn is neither.
NEXT = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
_BLANKS = "\t\n\x0b\x0c\r "

Row = tuple[str, int]  # role initial, fault (0: none)
Node = tuple[int, int]  # rows read, state


def _forward(rows: list[Row], node: Node) -> Iterator[tuple[Node, int, str]]:
    """Edges out of a node: where to, cost, edit."""
    i, state = node
    yield (i, NEXT[state]), INSERT, "I"
    if i == len(rows):
        return
    initial, fault = rows[i]
    yield (i + 1, state), DELETE, "D"
    if fault in (BLANK, DUPLICATE):
        return
    more = int(fault == TRUNCATED)
    if (state, initial) in STEP:
        yield (i + 1, STEP[state, initial]), more, "K"
    yield (i + 1, NEXT[state]), RETELL + more, "R"


def _backward(rows: list[Row], node: Node) -> Iterator[tuple[Node, int, str]]:
    """Edges into a node: where from, cost, edit."""
    i, state = node
    for before in (NOTHING, SYSTEM, USER, ASSISTANT):
        if NEXT[before] == state:
            yield (i, before), INSERT, "I"
    if not i:
        return
    initial, fault = rows[i - 1]
    yield (i - 1, state), DELETE, "D"
    if fault in (BLANK, DUPLICATE):
        return
    more = int(fault == TRUNCATED)
    for before in (NOTHING, SYSTEM, USER, ASSISTANT):
        if STEP.get((before, initial)) == state:
            yield (i - 1, before), more, "K"
        if NEXT[before] == state:
            yield (i - 1, before), RETELL + more, "R"


class _Side:
    """One search: least cost and, of equal costs, least audit from its starts to each node it has finished.

    Edges of no cost only go on to the next row, so nodes of equal cost are finished in order of rows: by then all
    audits of that cost are known.  No audit to a node begins another one of the same cost, as what came after could
    only be insertions; so the least audit of a way is made of least audits of its parts.
    """

    def __init__(self, rows: list[Row], starts: list[Node], ahead: bool) -> None:
        self.rows, self.ahead = rows, ahead
        self.edges = _forward if ahead else _backward
        self.known: dict[Node, tuple[int, str]] = {s: (0, "") for s in starts}
        self.done: dict[Node, tuple[int, str]] = {}
        self.heap = [(0, s[0] if ahead else -s[0], s) for s in starts]
        heapq.heapify(self.heap)

    def least(self) -> int | None:
        """Cost of the next node to finish."""
        while self.heap and (self.heap[0][2] in self.done or self.known[self.heap[0][2]][0] < self.heap[0][0]):
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else None

    def step(self) -> Node:
        cost, _, node = heapq.heappop(self.heap)
        audit = self.known[node][1]
        self.done[node] = cost, audit
        for other, more, edit in self.edges(self.rows, node):
            if other in self.done:
                continue
            found = cost + more, (audit + edit if self.ahead else edit + audit)
            if other not in self.known or found < self.known[other]:
                if other not in self.known or found[0] < self.known[other][0]:
                    heapq.heappush(self.heap, (found[0], other[0] if self.ahead else -other[0], other))
                self.known[other] = found
        return node


def cheapest(rows: list[Row], start: int, ends: tuple[int, ...]) -> tuple[int, str] | None:
    """Cost and ASCII-least audit of the cheapest edits of ``rows`` from state ``start`` to one of ``ends``.

    Two searches, from the start and from the ends, take turns by cost and cross where an edge (or no edge) joins what
    both have finished.  Once their next costs add up to more than the best crossing, all crossings of its cost are
    known, and the least audit through one of them is the answer.  None if no edits lead there.
    """
    here, there = _Side(rows, [(0, start)], True), _Side(rows, [(len(rows), e) for e in ends], False)
    best: tuple[int, str] | None = None
    while (a := here.least()) is not None and (b := there.least()) is not None:
        if best is not None and a + b > best[0]:
            break
        side, other = (here, there) if a <= b else (there, here)
        node = side.step()
        cost, audit = side.done[node]
        for to, more, edit in [(node, 0, ""), *side.edges(rows, node)]:
            if to in other.done:
                far, rest = other.done[to]
                found = cost + more + far, audit + edit + rest if side.ahead else rest + edit + audit
                best = found if best is None else min(best, found)
    return best


def edited(rows: list[tuple[str, str]], audit: str, state: int) -> tuple[list[str], int]:
    """``role:text`` of what the edits leave of (role, text) rows, and the state after them."""
    names, out, turns = {USER: "user", ASSISTANT: "assistant"}, [], iter(rows)
    for edit in audit:
        role, text = next(turns) if edit != "I" else ("", "")
        if edit == "D":
            continue
        state = STEP[state, role[:1]] if edit == "K" else NEXT[state]
        out.append(f"{role if edit == 'K' else names[state]}:{text}")
    return out, state


def damaged(convs: DataFrame) -> DataFrame:
    """Rows after damage: conv, turn, role, text; conv is conv_id as text.

    The CRC-32 of ``conv_id:turn`` modulo 20 decides: 0 drops a row, 1 empties its text, 2 removes ``.!?`` from it, 3
    repeats it, 4 makes its role user.  Nulls count as one space; ``turn`` stays null.
    """
    blank = F.lit(" ")
    conv, turn = (F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn"))
    kind = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    rows = convs.select(
        *[conv.alias("conv"), F.col("turn").cast("long"), kind.alias("kind")],
        *[F.coalesce(c, blank).alias(c) for c in ("role", "text")],
    ).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
    times = F.when(F.col("kind") == 3, 2).otherwise(1)
    return rows.select(
        *["conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role")],
        text.otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), times)).alias("copy"),
    ).drop("copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """Rows in ranges sorted by conversation, turn (nulls first), role and text, with each row's first fault.

    Columns: pos, conv, turn, role, text, fault, text_hash, uid; pos goes up with the order, by one inside a range.  Whether role and text came earlier is decided
    against the first such row of the conversation; the rows after it in the order are duplicates.
    """
    rows = rows.withColumns({"text_hash": F.sha2("text", 256), "uid": F.monotonically_increasing_id()})
    rows = materialize(rows, "repair-rows")
    place = F.struct("turn", "uid")
    alike = ["conv", "role", "text_hash"]
    first = rows.groupBy(*alike).agg(F.min(place).alias("first"))
    text = F.col("text")
    last = F.substring(F.rtrim(text, F.lit(_BLANKS)), -1, 1)
    fault: Column = F.when(last == "", BLANK).when(F.struct("turn", "uid") > F.col("first"), DUPLICATE)
    fault = fault.when(~last.isin(".", "!", "?"), TRUNCATED).otherwise(0)
    marked = rows.join(first, alike).select("conv", "turn", "role", "text", fault.alias("fault"), "text_hash", "uid")
    order = ["conv", "turn", "role", "text_hash", "uid"]
    ranges = materialize(marked, "repair-marked").repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(ranges.withColumn("pos", F.monotonically_increasing_id()), "repair-ranges")


_SOLVED = (
    "pos long, conv string, n long, blank long, duplicate long, truncated long, illegal long, first string, "
    "last string, cost long, audit string, sha string, costs array<int>, audits array<string>"
)


def solved_segments(ranges: DataFrame, size: int = SEGMENT) -> DataFrame:
    """Segments of at most ``size`` turns of one conversation, solved.

    Turns are read in runs without a gap in ``pos``, which are ranges or parts of them.  Each segment has its counts and its outer roles; a run that may be a whole conversation its cheapest repair; one that may be
    part of a longer conversation (in the first or last of a run, or one of several) the cheapest repair between each two
    states, at ``costs[4 * before + after]``, null where there is none.
    """

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("pos", pa.int64()), ("conv", pa.string())]
            + [(c, pa.int64()) for c in ("n", "blank", "duplicate", "truncated", "illegal")]
            + [("first", pa.string()), ("last", pa.string()), ("cost", pa.int64()), ("audit", pa.string()), ("sha", pa.string())]
            + [("costs", pa.list_(pa.int32())), ("audits", pa.list_(pa.string()))]
        )

        def stream() -> Iterator[tuple]:
            run, after = 0, None
            for batch in batches:
                for row in zip(*[batch.column(c).to_pylist() for c in range(5)]):
                    run += row[0] != after
                    after = row[0] + 1
                    yield (run, *row)

        def segments() -> Iterator[tuple[bool, list]]:
            """Each segment, and whether it is one of several of its conversation in its run."""
            for _, own in groupby(stream(), key=lambda r: (r[0], r[2])):
                held: list = []
                many = False
                for row in own:
                    if len(held) == size:
                        many = True
                        yield many, held
                        held = []
                    held.append(row)
                yield many, held

        def result(rows: list, many: bool) -> dict:
            run, pos, conv = rows[0][:3]
            turns = [(r[3][:1], r[5]) for r in rows]
            illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(turns, turns[1:]))
            found = {k: sum(f == code for _, f in turns) for k, code in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED))}
            found |= {"pos": pos, "conv": conv, "n": len(rows), "illegal": illegal, "first": turns[0][0], "last": turns[-1][0]}
            if not many:
                cost, audit = cheapest(turns, NOTHING, ENDS)
                kept, _ = edited([(r[3], r[4]) for r in rows], audit, NOTHING)
                found |= {"cost": cost, "audit": audit, "sha": hashlib.sha256("\n".join(kept).encode()).hexdigest()}
            return found | {"turns": turns, "run": run}

        def matrix(found: dict) -> dict:
            ways = [cheapest(found["turns"], p, (q,)) for p in range(STATES) for q in range(STATES)]
            return found | {"costs": [w and w[0] for w in ways], "audits": [w and w[1] for w in ways]}

        out: list[dict] = []
        before = None
        opening = True  # the conversation that a run begins with may have begun earlier
        for many, rows in segments():
            found = result(rows, many)
            if before is not None:
                run, same = before["run"] == found["run"], before["conv"] == found["conv"]
                out.append(before if run and not opening and not same and before.get("cost") is not None else matrix(before))
                opening = not run or opening and same
            before = found
            if len(out) >= 200:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if before is not None:
            out.append(matrix(before))
            yield pa.RecordBatch.from_pylist(out, schema)

    return materialize(ranges.select("pos", "conv", "role", "text", "fault").mapInArrow(solve, _SOLVED), "repair-solved")


def _by_conversation(rows: DataFrame, order: list, run: Callable, schema: str) -> DataFrame:
    """Rows of each conversation in order as one stream; what is kept of them does not grow with their texts."""
    return rows.repartition("conv").sortWithinPartitions("conv", *order).mapInArrow(run, schema)


def put_together(parts: DataFrame) -> DataFrame:
    """The cheapest repair of conversations of several segments: conv, cost, audit, seams.

    ``parts`` are their segments.  They are gone through from the last to the first; from each state the cheapest way to
    the end is held, as one audit for each state.  ``seams`` are the illegal neighbours where segments meet.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stream() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*[batch.column(c).to_pylist() for c in range(5)])

        for conv, own in groupby(stream(), key=lambda r: r[0]):
            ways, seams, after = {e: (0, "") for e in ENDS}, 0, None
            for _, costs, audits, first, last in own:
                found: dict[int, tuple[int, str]] = {}
                for p in range(STATES):
                    for q, (cost, audit) in ways.items():
                        if costs[STATES * p + q] is not None:
                            way = costs[STATES * p + q] + cost, audits[STATES * p + q] + audit
                            found[p] = min(found.get(p, way), way)
                seams += after is not None and last + after not in ("su", "ua", "au")
                ways, after = found, first
            cost, audit = ways[NOTHING]
            values = [[conv], [cost], [audit], [seams]]
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds)], ["conv", "cost", "audit", "seams"])

    rows = parts.select("conv", "costs", "audits", "first", "last", "pos")
    return materialize(_by_conversation(rows, [F.desc("pos")], fold, "conv string, cost long, audit string, seams long"), "repair-joined")


def repaired_hashes(ranges: DataFrame, joined: DataFrame) -> DataFrame:
    """(conv, sha) of conversations put together: their turns stream past the audit, and only a running hash is kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stream() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*[batch.column(c).to_pylist() for c in range(4)])

        for conv, own in groupby(stream(), key=lambda r: r[0]):
            audit = next(own)[3]  # stands before the turns
            digest, state, between = hashlib.sha256(), NOTHING, ""
            turns = (r[1:3] for r in own)
            for edit in audit:
                kept, state = edited([next(turns)] if edit != "I" else [], edit, state)
                for line in kept:
                    digest.update((between + line).encode())
                    between = "\n"
            yield pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([digest.hexdigest()])], ["conv", "sha"])

    turns = ranges.join(joined.select("conv"), "conv", "left_semi").select(
        *["conv", "role", "text", F.lit(None).cast("string").alias("audit"), "pos"]
    )
    heads = joined.select("conv", F.lit("").alias("role"), F.lit("").alias("text"), "audit", F.lit(-1).cast("long").alias("pos"))
    rows = turns.unionByName(heads)
    return _by_conversation(rows, ["pos"], run, "conv string, sha string")


def repaired_conversations(convs: DataFrame, *, segment: int = SEGMENT) -> DataFrame:
    """Damage, diagnose and repair conversations: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256.

    Rows are damaged as :func:`damaged` says and taken by turn, nulls first; rows of one turn by role and hash of the
    text.  A row's first fault counts: blank, duplicate (role and text seen earlier), truncated (does not end in
    ``.!?``).  ``gaps`` are turns missing between the first and the last, ``illegal`` neighbours other than su, ua, au.

    Edits keep a row (K), give it the role user or assistant (R, 2), delete it (D, 3; required for blank and duplicate
    rows) or insert an empty user or assistant turn (I, 2); truncated rows that stay cost 1.  The cheapest edits that
    leave roles ``(s?(ua)+)?`` are found, of equal ones those with the ASCII-least audit, which decides all edits.

    Rows lie in sorted ranges.  Conversations inside one range and of at most ``segment`` turns are solved at once;
    longer ones segment by segment between all states, and the segments are put together from the end, so that a
    conversation may hold most rows.  Its audit is one string, as the result is.

    Null conv_id rows are one conversation; null roles and texts are one space.  A conversation with no rows left has
    zeros, an empty audit and the hash of an empty string.  No rows in, no rows out; other columns are not read.
    """
    rows = materialize(damaged(convs), "repair-damaged")
    turns = rows.groupBy("conv").agg(F.min("turn").alias("lo"), F.max("turn").alias("hi"), F.count_distinct("turn").alias("met"))
    gaps = turns.select("conv", F.coalesce(F.expr("hi - lo + 1 - met"), F.lit(0)).cast("long").alias("gaps"))
    ranges = with_faults(rows)
    parts = solved_segments(ranges, segment)
    several = parts.groupBy("conv").agg(
        F.count(F.lit(1)).alias("parts"),
        *[F.max(c).alias(c) for c in ("cost", "audit", "sha")],
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")],
    )
    several = materialize(several, "repair-several")
    long = materialize(several.filter("parts > 1").select("conv"), "repair-long")
    pieces = parts.join(long, "conv", "left_semi")
    joined = put_together(pieces)
    hashes = materialize(repaired_hashes(ranges, joined), "repair-hashes")
    whole = joined.select("conv", F.col("cost").alias("cost_"), F.col("audit").alias("audit_"), "seams")
    solved = several.join(whole.join(hashes.withColumnRenamed("sha", "sha_"), "conv"), "conv", "left")
    solved = solved.join(gaps, "conv").select(
        *["conv", "gaps", "blank", "duplicate", "truncated", (F.col("illegal") + F.coalesce("seams", F.lit(0))).alias("illegal")],
        *[F.when(F.col("parts") > 1, F.col(f"{c}_")).otherwise(F.col(c)).alias(c) for c in ("cost", "audit", "sha")],
    )
    names = convs.select("conv_id").distinct()
    names = names.withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")))
    zero = F.lit(0).cast("long")
    return names.join(solved, "conv", "left").select(
        "conv_id",
        *[F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
