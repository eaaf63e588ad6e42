"""Conversation structure repair: A* on the lattice of edits.

A conversation's rows are read in order. Each may be kept (K, cost 0), given another role
(R, 1) or deleted (D, 2; blank and duplicate rows must be), and an empty user or assistant
turn may be put in anywhere (I, 5); a truncated row that is not deleted costs 5 more. The
role initials of what is left must be ``(s?(ua)+)?``. Nodes of the lattice are (rows read,
last role put out). The search is keyed (cost plus heuristic, audit); the heuristic is the
suffix sum of the mandatory deletions and of the 2 that each truncated row costs at least,
as deleting it is the cheapest way round its charge. It is consistent, and an audit is
never smaller than its prefixes, so the first visit to a node has its least (cost, audit).

Scale. The search sees one light row for each different row: its turn, role, flags, the
digest of its text and how often it occurs. These are range partitioned by conversation
and order, so a conversation that holds a third of all rows is spread over many tasks;
each task searches segments of at most ``SEGMENT`` rows from every state they may be
entered in, and segments are then chained by (cost, audit). Chaining, and handing out the
repaired turns, are streams over sorted rows: a task holds a batch, and the one audit.

Order and ties. Rows are ordered by (turn, nulls first; role; SHA-256 of the text); equal
rows are adjacent. Null roles and texts are one space, so a null text is blank; a row whose
role is empty or begins with none of s, u, a is rewritten or deleted. Rows with a null
conv_id are one conversation, whose id is null. Other columns of the table are not read,
whatever their names. No rows: no conversations.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import reachable, tidy_stream

RETITLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Rows that are searched at once; longer conversations are chained of segments.
SEGMENT = 256
#: States: nothing put out yet, a system turn, a user turn, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Rows in a batch of repaired turns.
BATCH = 2_000
_WORD = r"[^\x20\x09-\x0D]"


def damaged(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text, copies: ``turns`` with planted faults, by crc32(``conv_id:turn``) modulo 20.

    0 drops a row, 1 empties its text, 2 removes its ``[.!?]``, 3 repeats it (copies is 2),
    4 makes it the user's. Nulls are one space, in the hashed key also.
    """
    c, t = F.col(f"`{conv_id}`"), F.col(f"`{turn}`")
    said, spoken = (F.coalesce(F.col(f"`{x}`"), F.lit(" ")) for x in (text, role))
    key = F.concat(F.coalesce(c.cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(t.cast("string"), F.lit(" ")))
    rows = turns.select(c.alias("conv_id"), t.alias("turn"), spoken.alias("role"), said.alias("text"), (F.crc32(key) % 20).alias("_fault")).filter("_fault != 0")
    fault = F.col("_fault")
    return rows.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(fault == 3, 2).otherwise(1).alias("copies"),
    )


def _rows(turns: DataFrame) -> DataFrame:
    copies = F.col("copies") if "copies" in turns.columns else F.lit(1)
    return turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), copies.cast("long").alias("copies"),
    ).withColumn("digest", F.sha2("text", 256))


def _order() -> list[Column]:
    return [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest")]


def search(rows: list[tuple[str, bool, bool]], entry: int, whole: bool = False) -> dict[int, tuple[int, str]]:
    """Least (cost, audit) from ``entry`` to each state after all ``rows`` (role initial, must go, truncated).

    With ``whole`` it ends at the first state in which a conversation may end.
    """
    n = len(rows)
    left = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        left[i] = left[i + 1] + DELETE * (rows[i][1] or rows[i][2])
    heap, seen, out = [(left[0], "", 0, entry)], set(), {}
    while heap:
        f, audit, i, state = heapq.heappop(heap)
        if (i, state) in seen:
            continue
        seen.add((i, state))
        cost = f - left[i]
        if i == n:
            out[state] = (cost, audit)
            if whole and state in (START, ASSISTANT):
                return {state: (cost, audit)}
        wanted, after = ("a", ASSISTANT) if state == USER else ("u", USER)
        if i < n:
            initial, must_go, truncated = rows[i]
            f = cost + left[i + 1]
            heapq.heappush(heap, (f + DELETE, audit + "D", i + 1, state))
            if not must_go:
                f += TRUNCATED * truncated
                heapq.heappush(heap, (f, audit + "K", i + 1, after) if initial == wanted else (f + RETITLE, audit + "R", i + 1, after))
                if initial == "s" and state == START:
                    heapq.heappush(heap, (f, audit + "K", i + 1, SYSTEM))
        heapq.heappush(heap, (cost + INSERT + left[i], audit + "I", i, after))
    return out


class Segment:
    """Adjacent rows of one conversation."""

    def __init__(self, conv_id, number: int):
        self.conv_id, self.number, self.rows, self.illegal, self.n_turns = conv_id, number, [], 0, 0
        self.counts, self.low, self.high = [0, 0, 0], None, None

    def add(self, turn, initial: str, blank: bool, duplicate: bool, truncated: bool) -> None:
        if self.rows and self.rows[-1][0] + initial not in ("su", "ua", "au"):
            self.illegal += 1
        if turn is not None and turn != self.high:
            self.n_turns += 1
            self.low, self.high = (turn if self.low is None else self.low), turn
        fault = 0 if blank else 1 if duplicate else 2 if truncated else None
        if fault is not None:
            self.counts[fault] += 1
        self.rows.append((initial, fault in (0, 1), fault == 2))

    def row(self, part: int, first: bool, last: bool) -> dict:
        """``first`` and ``last``: whether the conversation is known to begin and to end here."""
        entries = (START,) if first else range(4)
        found = {q: search(self.rows, q, first and last) for q in entries}
        ways = [{"entry": q, "exit": e, "cost": c, "audit": a} for q, x in found.items() for e, (c, a) in x.items()]
        names = ("blank", "duplicate", "truncated")
        return {
            "conv_id": self.conv_id, "part": part, "number": self.number, "head": self.rows[0][0], "tail": self.rows[-1][0],
            "illegal": self.illegal, "low": self.low, "high": self.high, "n_turns": self.n_turns, **dict(zip(names, self.counts, strict=True)), "ways": ways,
        }


_SEGMENT = "part int, number int, head string, tail string, illegal long, low long, high long, n_turns long, blank long, duplicate long, truncated long, ways array<struct<entry:int,exit:int,cost:long,audit:string>>"
_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _typed(rows: DataFrame) -> str:
    return f"conv_id {rows.schema['conv_id'].dataType.simpleString()}"


def _segments(schema: pa.Schema, size: int):
    """Segments of a partition's sorted rows. What its first conversation has before, and its last one after, is in other partitions."""

    def each(batches):
        part, held, number, alone, out = TaskContext.get().partitionId(), None, 0, False, []
        for batch in batches:
            for r in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "turn", "initial", "n", "blank", "duplicate", "truncated")), strict=True):
                for k in range(r[3]):
                    if held is None or held.conv_id != r[0] or len(held.rows) == size:
                        ends = held is not None and held.conv_id != r[0]
                        if held is not None:
                            out.append(held.row(part, alone and held.number == 0, ends))
                        alone, number = (True, 0) if ends else (alone, number + 1)
                        held = Segment(r[0], number)
                    held.add(r[1], r[2], r[4], r[5] or k > 0, r[6])
            if len(out) >= BATCH:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if held is not None:
            out.append(held.row(part, alone and held.number == 0, False))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return each


def _wrapped(x: int) -> int:
    return (x + (1 << 63)) % (1 << 64) - (1 << 63)


class Chain:
    """Segments of one conversation, put together in order."""

    def __init__(self, conv_id):
        self.conv_id, self.tail, self.low, self.high = conv_id, None, None, None
        self.best, self.n_turns, self.sums = {START: (0, "")}, 0, {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}

    def add(self, s: dict) -> None:
        for k in self.sums:
            self.sums[k] += s[k]
        if self.tail is not None and self.tail + s["head"] not in ("su", "ua", "au"):
            self.sums["illegal"] += 1
        self.tail = s["tail"]
        if s["low"] is not None:
            self.n_turns += s["n_turns"] - (s["low"] == self.high)
            self.low, self.high = (s["low"] if self.low is None else self.low), s["high"]
        found: dict[int, tuple[int, str]] = {}
        for w in s["ways"]:
            if w["entry"] in self.best:
                cost, audit = self.best[w["entry"]]
                way = (cost + w["cost"], audit + w["audit"])
                found[w["exit"]] = min(way, found.get(w["exit"], way))
        self.best = found

    def row(self) -> dict:
        cost, audit = min(self.best[q] for q in (START, ASSISTANT) if q in self.best)
        gaps = 0 if self.low is None else _wrapped(self.high - self.low + 1 - self.n_turns)
        return {"conv_id": self.conv_id, "gaps": gaps, "cost": cost, "audit": audit} | self.sums


def _chains(schema: pa.Schema):
    def each(batches):
        held, out = None, []
        for batch in batches:
            for s in batch.to_pylist():
                if held is None or held.conv_id != s["conv_id"]:
                    if held is not None:
                        out.append(held.row())
                    held = Chain(s["conv_id"])
                held.add(s)
            if len(out) >= BATCH:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if held is not None:
            out.append(held.row())
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return each


def _arrow(schema: str, spark) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def reports(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit for every conversation of ``turns`` (conv_id, turn, role, text, and maybe copies).

    gaps: turns missing between the least and the greatest, nulls apart. Each row's first
    fault counts: blank (only white space), duplicate (role and text seen earlier),
    truncated (its last character but white space is none of ``.!?``). illegal: adjacent
    role initials that are none of su, ua, au. audit: the initials of the cheapest edits,
    the least of them where several cost the same.
    """
    spark = reachable(turns.sparkSession)
    rows = _rows(turns)
    # facts of the text are constant within a digest, so grouping by them does not part rows
    light = (
        rows.select("conv_id", "turn", "role", "digest", "copies", (~F.col("text").rlike(_WORD)).alias("blank"), (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"))
        .groupBy("conv_id", "turn", "role", "digest", "blank", "truncated").agg(F.sum("copies").alias("n"))
    )
    first = light.groupBy("conv_id", "role", "digest").agg(F.min(F.struct(F.col("turn").isNotNull(), F.col("turn"))).alias("f"), F.count("*").alias("k")).filter("k > 1")
    first = first.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), F.col("f.turn").alias("since"), F.lit(True).alias("again"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    flagged = light.join(first, same, "left").withColumn("duplicate", F.col("again").isNotNull() & ~F.col("turn").eqNullSafe(F.col("since")))
    ordered = flagged.select("conv_id", "turn", "role", "digest", F.substring("role", 1, 1).alias("initial"), "n", "blank", "duplicate", "truncated")
    ordered = ordered.repartitionByRange(*_order()).sortWithinPartitions(*_order()).drop("role", "digest")
    schema = f"{_typed(rows)}, {_SEGMENT}"
    segments = ordered.mapInArrow(tidy_stream(_segments(_arrow(schema, spark), segment)), schema)
    chained = segments.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "part", "number")
    schema = f"{_typed(rows)}, {_REPORT}"
    return chained.mapInArrow(tidy_stream(_chains(_arrow(schema, spark))), schema)


class Editor:
    """Hands out the turns that an audit makes of a conversation's rows."""

    def __init__(self, conv_id, audit: str):
        self.conv_id, self.audit, self.at, self.state, self.position = conv_id, audit, 0, START, 0

    def _put(self, edit: str, role: str, text: str) -> dict:
        self.position += 1
        return {"conv_id": self.conv_id, "position": self.position - 1, "edit": edit, "role": role, "text": text}

    def _next(self) -> str:
        self.state = ASSISTANT if self.state == USER else USER
        return "assistant" if self.state == ASSISTANT else "user"

    def inserts(self):
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._put("I", self._next(), "")

    def rows(self, role: str, text: str):
        yield from self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            yield self._put(edit, self._next(), text)
        elif edit == "K":
            if self.state == START and role.startswith("s"):
                self.state = SYSTEM
            else:
                self._next()
            yield self._put(edit, role, text)


def _editing(schema: pa.Schema):
    def edited(batches):
        held = None
        for batch in batches:
            columns = (batch.column(k).to_pylist() for k in ("conv_id", "kind", "role", "text", "copies"))
            for conv_id, kind, role, text, copies in zip(*columns, strict=True):
                if not kind:
                    if held is not None:
                        yield from held.inserts()
                    held = Editor(conv_id, text)
                    continue
                for _ in range(copies):
                    yield from held.rows(role, text)
        if held is not None:
            yield from held.inserts()

    def each(batches):
        out, size = [], 0
        for row in edited(batches):
            out.append(row)
            size += len(row["text"])
            if len(out) >= BATCH or size >= 8_000_000:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return each


def repaired(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """conv_id, position (from 0), edit, role, text: ``turns`` after the edits that ``audits`` (conv_id, audit; of ``reports``) names.

    Each conversation's turns come one after another, in order, in one partition.
    """
    spark = reachable(turns.sparkSession)
    rows = _rows(turns)
    heads = audits.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(1).cast("long").alias("copies"), F.lit("").alias("digest"))
    both = heads.unionByName(rows.withColumn("kind", F.lit(1)))
    order = _order()
    both = both.repartition("conv_id").sortWithinPartitions(order[0], "kind", *order[1:]).drop("digest", "turn")
    schema = f"{_typed(rows)}, position long, edit string, role string, text string"
    return both.mapInArrow(tidy_stream(_editing(_arrow(schema, spark))), schema)


def _digesting(schema: pa.Schema):
    import hashlib

    def each(batches):
        held, sha, out = None, None, []
        for batch in batches:
            for conv_id, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "role", "text")), strict=True):
                if sha is None or held != conv_id:
                    if sha is not None:
                        out.append({"conv_id": held, "sha256": sha.hexdigest()})
                    held, sha = conv_id, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode())
        if sha is not None:
            out.append({"conv_id": held, "sha256": sha.hexdigest()})
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    return each


def digests(turns: DataFrame) -> DataFrame:
    """conv_id, sha256 (of ``role:text``, newline-joined) for each conversation of what ``repaired`` returns; its order must not have been changed."""
    schema = f"{_typed(turns)}, sha256 string"
    return turns.mapInArrow(_digesting(_arrow(schema, turns.sparkSession)), schema)
