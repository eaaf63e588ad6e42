"""Conversation structure repair against every possible edit, and against a plain walk over the lattice."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from curatrix.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
GOOD = re.compile(r"(s?(ua)+)?")
WORD = re.compile(r"[^\x20\x09-\x0D]")


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault, role, text = zlib.crc32(key.encode()) % 20, " " if role is None else role, " " if text is None else text
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def brute_flags(rows):
    """Rows of one conversation in order, with their first fault."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for _, t, r, x in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), hashlib.sha256(x[2].encode()).hexdigest()))
    seen, out = set(), []
    for turn, role, text in rows:
        words = WORD.findall(text)
        fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((turn, role, text, fault))
    return out


def every_edit(rows):
    """Least (cost, audit) over all edits of a few rows, with at most two insertions in a place."""
    put = [x for n in range(3) for x in itertools.product("ua", repeat=n)]
    ways = [[("D", "", 2)] + ([] if f in ("blank", "duplicate") else [("K", r[:1] or "-", 5 * (f == "truncated")), ("R", "u", 1 + 5 * (f == "truncated")), ("R", "a", 1 + 5 * (f == "truncated"))]) for _, r, _, f in rows]
    best = None
    for chosen in itertools.product(*ways):
        for gaps in itertools.product(put, repeat=len(rows) + 1):
            said = "".join(gaps[0]) + "".join(c[1] + "".join(g) for c, g in zip(chosen, gaps[1:], strict=True))
            if GOOD.fullmatch(said):
                cost = sum(c[2] for c in chosen) + 5 * sum(map(len, gaps))
                audit = "I" * len(gaps[0]) + "".join(c[0] + "I" * len(g) for c, g in zip(chosen, gaps[1:], strict=True))
                best = min(best or (cost, audit), (cost, audit))
    return best


def walk(rows):
    """The same for any number of rows: least (cost, audit, turns put out) for each last role, row by row."""
    wanted = {"": "u", "s": "u", "u": "a", "a": "u"}

    def put_in(states):
        for _ in range(2):
            for q, (cost, audit, out) in list(states.items()):
                way = (cost + 5, audit + "I", [*out, ("user" if wanted[q] == "u" else "assistant", "")])
                states[wanted[q]] = min(states.get(wanted[q], way), way)
        return states

    states = put_in({"": (0, "", [])})
    for _, role, text, fault in rows:
        after = {}
        for q, (cost, audit, out) in states.items():
            ways = [(q, (cost + 2, audit + "D", out))]
            if fault not in ("blank", "duplicate"):
                more, u = cost + 5 * (fault == "truncated"), wanted[q]
                if role[:1] == u or (q == "" and role[:1] == "s"):
                    ways.append((role[:1], (more, audit + "K", [*out, (role, text)])))
                if role[:1] != u:
                    ways.append((u, (more + 1, audit + "R", [*out, ("user" if u == "u" else "assistant", text)])))
            for to, way in ways:
                after[to] = min(after.get(to, way), way)
        states = put_in(after)
    return min(states[q] for q in ("", "a") if q in states)


def brute(rows):
    flagged = brute_flags(rows)
    cost, audit, out = walk(flagged)
    turns = [t for t, *_ in flagged if t is not None]
    counts = [sum(f == k for *_, f in flagged) for k in ("blank", "duplicate", "truncated")]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(flagged, flagged[1:], strict=False))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *counts, illegal, cost, audit), out


def some_rows(r, conv, n):
    said = [None, "", " \n", "Yes.", "No?", "cut off", "Wait!  \n", "w.x", "?", "Again.", "é…", "More. "]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "usher", "Assistant"]
    return [(conv, r.choice([None, *range(-2, n + 3)]), r.choice(roles), r.choice(said)) for _ in range(n)]


def test_search_against_every_edit():
    r = random.Random(5)
    for _ in range(60):
        rows = brute_flags(some_rows(r, 1, r.randrange(0, 4)))
        light = [(x[:1], f in ("blank", "duplicate"), f == "truncated") for _, x, _, f in rows]
        want = every_edit(rows)
        assert walk(rows)[:2] == want
        assert list(repair.search(light, repair.START, True).values()) == [want]
        ends = repair.search(light, repair.START)
        assert min(v for q, v in ends.items() if q in (repair.START, repair.ASSISTANT)) == want


@pytest.mark.parametrize("segment", [3, 256])
def test_reports_and_repaired_turns(spark, segment):
    r = random.Random(segment)
    rows = [x for c in [*range(40), None] for x in some_rows(r, c, r.randrange(1, 12))] + some_rows(r, 77, 90)  # the last is many segments
    rows += [(99, 1, "user", "Same.")] * 40  # repeated rows
    df = spark.createDataFrame(rows, SCHEMA).withColumn("audit", F.lit("x")).withColumn("kind", F.lit(3)).repartition(5)
    turns = repair.damaged(df)
    damaged = brute_damage(rows)
    assert sorted(map(str, damaged)) == sorted(str(tuple(x[:4])) for x in turns.collect() for _ in range(x.copies))
    by = {}
    for x in damaged:
        by.setdefault(x[0], []).append(x)
    want = {c: brute(x) for c, x in by.items()}
    got = repair.reports(turns, segment)
    assert {x.conv_id: tuple(x[1:]) for x in got.collect()} == {c: w[0] for c, w in want.items()}
    fixed = repair.repaired(turns, got)
    said = {}
    for x in fixed.collect():
        said.setdefault(x.conv_id, []).append((x.position, x.role, x.text))
    assert {c: [y[1:] for y in sorted(x)] for c, x in said.items()} == {c: w[1] for c, w in want.items() if w[1]}
    for x in said.values():
        assert GOOD.fullmatch("".join(y[1][:1] for y in sorted(x)))
    shas = {x.conv_id: x.sha256 for x in repair.digests(fixed).collect()}
    assert shas == {c: hashlib.sha256("\n".join(f"{a}:{b}" for a, b in w[1]).encode()).hexdigest() for c, w in want.items() if w[1]}


def test_one_conversation_over_many_partitions(spark):
    """A conversation that holds all rows is searched by many tasks."""
    r = random.Random(9)
    rows = some_rows(r, 5, 2_000)
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = repair.reports(df, 64).collect()
    assert len(got) == 1 and tuple(got[0][1:]) == brute(rows)[0]


def test_long_texts_ties_and_nothing(spark):
    assert repair.reports(spark.createDataFrame([], SCHEMA)).collect() == []
    assert repair.repaired(spark.createDataFrame([], SCHEMA), repair.reports(spark.createDataFrame([], SCHEMA))).collect() == []
    long = "word " * 200_000
    rows = [(1, 0, "user", long + "."), (1, 0, "assistant", long), (1, 0, "user", "b."), (1, 0, "user", "a."), (1, 1, "assistant", "c.")]
    assert tuple(repair.reports(spark.createDataFrame(rows, SCHEMA)).first()[1:]) == brute(rows)[0]


def test_registered_query_keeps_conversations_that_lost_all_rows(spark, tmp_path):
    from curatrix.llm import queries

    drops = [k for k in range(4000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0][:2]
    rows = [(k, 0, "user", "Hello.") for k in drops] + [(None, None, None, None), (5000, 1, "user", "Hello there.")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {x.conv_id: tuple(x[1:]) for x in queries.op11_conversation_repair(spark, str(tmp_path)).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert set(got) == {*drops, None, 5000}
    for k in drops:
        assert got[k] == (0, 0, 0, 0, 0, 0, "", empty)
