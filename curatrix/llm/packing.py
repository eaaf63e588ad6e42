"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

Documents become pieces of at most ``capacity`` tokens. Pieces are dealt by hash into
shards of about ``SHARD`` pieces, and each shard is a bin packing problem that several
islands, each a row of a table, work on by themselves: a population of packings is
crossed by injecting whole well-filled sequences of one parent into the other, dropping
the other's sequences that hold the same pieces, and putting displaced pieces back by
best fit. After each epoch an island's best packings move to the next island of its
shard. What a shard leaves in sequences that aren't nearly full is pooled with the
others' and packed once more, so a shard wastes next to nothing.

Shards are equal by construction, whatever the sources and lengths; a task holds one.
Every island starts from noisy orders of its own and goes through all its generations.
"""

from __future__ import annotations

import random
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import files_for, tidy_stream, written
from .tokens import crc32, tokenizer_of

CAPACITY, END = 4096, 1
SHARD, ISLANDS, EPOCHS = 3000, 3, 2
POPULATION, GENERATIONS, ELITES = 6, 15, 2
#: Sequences filled less are packed again with those of other shards.
NEARLY_FULL = 0.97

PIECE = "doc_id {kind}, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, tokenizer: str | None = None, end: int = END, with_ids: bool = False) -> DataFrame:
    """One row a piece of each document: doc_id, piece, start, length, ids_crc32 (and ids, little-endian 32-bit).

    A document's ids end with ``end``; a null or empty text is that id alone. Only
    documents of more than ``capacity`` ids are cut. Repeated rows, null ids and other
    columns are no matter: rows are independent.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    last = np.asarray([end], "<u4").tobytes()

    def cut(batches):
        tok = tokenizer_of(tokenizer)
        for batch in batches:
            names = batch.column(0)
            for first, ids, at in tok.encoded(batch.column(1)):
                out: list[tuple] = []
                for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
                    whole = ids[a:b].tobytes() + last
                    for k, s in enumerate(range(0, len(whole), 4 * capacity)):
                        part = whole[s : s + 4 * capacity]
                        out.append((first + i, k, s // 4, len(part) // 4, crc32(part), part if with_ids else None))
                columns = list(zip(*out, strict=True))
                arrays = [names.take(pa.array(columns[0])), *(pa.array(c, t) for c, t in zip(columns[1:5], (pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True))]
                fields = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays, fields = [*arrays, pa.array(columns[5], pa.binary())], [*fields, "ids"]
                yield pa.RecordBatch.from_arrays(arrays, names=fields)

    return rows.mapInArrow(tidy_stream(cut), PIECE.format(kind=dict(rows.dtypes)["doc_id"]) + (", ids binary" if with_ids else ""))


class Packing:
    """Sequences as lists of piece numbers, with how full each is, and what made it: fit, cross or mutate.

    Packings share their lists: one that changes is replaced.
    """

    def __init__(self, lengths: list[int], capacity: int, groups: list[list[int]] | None = None, fills: list[int] | None = None, origin: str = "fit"):
        self.lengths, self.capacity, self.origin = lengths, capacity, origin
        self.groups = groups if groups is not None else []
        self.fills = fills if fills is not None else [sum(map(lengths.__getitem__, g)) for g in self.groups]
        self._fitness: tuple[int, float] | None = None

    def best_fit(self, items: list[int]) -> Packing:
        """Put the items, in this order, where they leave least room."""
        groups, fills, lengths = self.groups, self.fills, self.lengths
        free = sorted((self.capacity - f, i) for i, f in enumerate(fills) if f < self.capacity)
        own: set[int] = set()  # lists of this packing alone
        for item in items:
            n = lengths[item]
            at = bisect_left(free, (n,))
            if at < len(free):
                room, g = free.pop(at)
                if g in own:
                    groups[g].append(item)
                else:
                    groups[g] = [*groups[g], item]
                    own.add(g)
                fills[g] += n
                room -= n
            else:
                g, room = len(groups), self.capacity - n
                groups.append([item])
                fills.append(n)
                own.add(g)
            if room:
                insort(free, (room, g))
        return self

    @property
    def fitness(self) -> tuple[int, float]:
        """Fewer sequences are better, then more uneven fills."""
        if self._fitness is None:
            self._fitness = -len(self.groups), sum(f * f for f in self.fills) / self.capacity**2
        return self._fitness

    def without(self, drop: set[int], gone: set[int], origin: str) -> tuple[Packing, list[int]]:
        """Without the groups numbered in ``drop``; the items they had that aren't ``gone``, longest first."""
        kept = [i for i in range(len(self.groups)) if i not in drop]
        displaced = [x for i in drop for x in self.groups[i] if x not in gone]
        child = Packing(self.lengths, self.capacity, [self.groups[i] for i in kept], [self.fills[i] for i in kept], origin)
        return child, sorted(displaced, key=self.lengths.__getitem__, reverse=True)

    def numbers(self) -> list[int]:
        out = [0] * len(self.lengths)
        for i, g in enumerate(self.groups):
            for x in g:
                out[x] = i
        return out


def cross(a: Packing, b: Packing, r: random.Random) -> Packing:
    """Inject some of b's best-filled sequences into a, drop a's sequences that hold the same pieces, and best-fit what is displaced."""
    full = sorted(range(len(b.groups)), key=b.fills.__getitem__, reverse=True)
    full = full[: max(1, len(full) // 2)]
    taken = r.sample(full, max(1, len(full) // 3))
    of_a = a.numbers()
    gone = {x for i in taken for x in b.groups[i]}
    child, displaced = a.without({of_a[x] for x in gone}, gone, "cross")
    child.groups += [b.groups[i] for i in taken]
    child.fills += [b.fills[i] for i in taken]
    return child.best_fit(displaced)


def mutate(a: Packing, r: random.Random) -> Packing:
    """Empty the worst-filled sequences and a few others, and refit."""
    order = sorted(range(len(a.groups)), key=a.fills.__getitem__)
    child, displaced = a.without({*order[:3], *r.sample(order, min(len(order), 3))}, set(), "mutate")
    return child.best_fit(displaced)


def evolve(lengths: list[int], capacity: int, seed: int, immigrants: list[list[int]] = (), generations: int = GENERATIONS) -> list[Packing]:
    """All generations on one island; its best packings.

    The population starts from the immigrants, and from best fit of the pieces in orders by
    length with noise.
    """
    r, items, population = random.Random(seed), range(len(lengths)), []
    if not lengths:
        return [Packing(lengths, capacity)]
    for numbers in immigrants:
        groups: list[list[int]] = [[] for _ in range(max(numbers) + 1)]
        for x, g in enumerate(numbers):
            groups[g].append(x)
        population.append(Packing(lengths, capacity, [g for g in groups if g]))
    while len(population) < POPULATION:
        noise = 0.05 * len(population) + 0.05
        order = sorted(items, key=lambda x: lengths[x] * (1 + noise * r.random()), reverse=True)
        population.append(Packing(lengths, capacity).best_fit(order))
    rank = lambda p: p.fitness
    for _ in range(generations):
        population.sort(key=rank, reverse=True)
        a, b = r.sample(population[:3], 2)
        children = [cross(a, b, r), cross(b, a, r), mutate(population[0], r)]
        population = sorted([*population, *children], key=rank, reverse=True)[:POPULATION]
    return population[:ELITES]


ISLAND = "shard long, island int, n int, fill double, made string, best array<array<int>>"


def _islands(batches):
    schema = pa.schema([("shard", pa.int64()), ("island", pa.int32()), ("n", pa.int32()), ("fill", pa.float64()), ("made", pa.string()), ("best", pa.list_(pa.list_(pa.int32())))])
    for batch in batches:
        for row in batch.to_pylist():
            epoch, held = row["epoch"], row["immigrants"] or ()
            elites = evolve(row["lengths"], row["capacity"], row["shard"] * 31 + row["island"] + 1000003 * epoch, held)
            top = elites[0]
            made = row["made"] if row["made"] and top.origin == "fit" else top.origin  # an immigrant keeps its own
            out = {"shard": row["shard"], "island": row["island"], "n": len(top.groups), "fill": top.fitness[1], "made": made, "best": [p.numbers() for p in elites]}
            yield pa.RecordBatch.from_pylist([out], schema=schema)


def _evolved(shards: DataFrame, n: int, capacity: int, files: int | None = None) -> DataFrame:
    """Each island's best packings after all epochs; between epochs the best one of each moves to the next island of its shard."""
    problems = shards.select("shard", F.transform("items", lambda x: x["length"]).alias("lengths"), F.lit(capacity).alias("capacity"))
    islands = problems.withColumn("island", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])))
    now = islands.withColumn("immigrants", F.lit(None).cast("array<array<int>>")).withColumn("made", F.lit(None).cast("string"))
    for epoch in range(EPOCHS):
        if epoch:
            own = found.select("shard", "island", F.col("best").alias("own"), "n", "fill", "made")
            moved = found.select("shard", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).cast("int").alias("island"), F.slice("best", 1, 1).alias("moved"), F.struct((-F.col("n")).alias("n"), "fill", "made").alias("from"))
            both = islands.join(own, ["shard", "island"]).join(moved, ["shard", "island"])
            made = F.greatest(F.struct((-F.col("n")).alias("n"), "fill", "made"), F.col("from"))["made"]
            now = both.select(*islands.columns, F.concat("own", "moved").alias("immigrants"), made.alias("made"))
        dealt = now.withColumn("epoch", F.lit(epoch)).repartition(max(1, min(n * ISLANDS, 10_000)), "shard", "island")
        found = written(dealt.mapInArrow(_islands, ISLAND), "islands", files)
    return found


def _shards(table: DataFrame, files: int | None = None) -> tuple[DataFrame, int]:
    """The rows of ``table`` (written) in shards of about ``SHARD``, equal rows apart from each other: shard, items (sorted)."""
    n = max(1, -(-table.count() // SHARD))
    shard = F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32", F.monotonically_increasing_id()), F.lit(n))
    item = F.struct("doc_id", "piece", "start", "length", "ids_crc32")
    return written(table.withColumn("shard", shard).groupBy("shard").agg(F.sort_array(F.collect_list(item)).alias("items")), "shards", files), n


def _pack(table: DataFrame, capacity: int, files: int | None = None) -> DataFrame:
    """The rows of ``table`` (written) with shard, group, offset and the group's fill."""
    shards, n = _shards(table, files)
    best = _evolved(shards, n, capacity, files).groupBy("shard").agg(F.min_by(F.get("best", 0), F.struct("n", -F.col("fill"), "island")).alias("groups"))
    pairs = shards.join(best, "shard").select("shard", F.explode(F.arrays_zip("items", "groups")).alias("x"))
    rows = pairs.select("shard", "x.items.*", F.col("x.groups").alias("group"))
    order = Window.partitionBy("shard", "group").orderBy("doc_id", "piece", "start", "length", "ids_crc32")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).withColumn("fill", F.sum("length").over(Window.partitionBy("shard", "group")))


def report(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """For each shard of ``parts``: sequences, made (what made its best packing: fit, cross or mutate), least (that lengths allow) and plain (of best fit alone)."""
    shards, n = _shards(written(parts.select("doc_id", "piece", "start", "length", "ids_crc32"), "pieces"))
    best = _evolved(shards, n, capacity).groupBy("shard").agg(F.min_by(F.struct("n", "made"), F.struct("n", -F.col("fill"), "island")).alias("best"))

    def plain(batches):
        for batch in batches:
            lengths = batch.column("lengths").to_pylist()
            fits = [len(Packing(x, capacity).best_fit(sorted(range(len(x)), key=x.__getitem__, reverse=True)).groups) for x in lengths]
            yield pa.RecordBatch.from_arrays([batch.column("shard"), pa.array([-(-sum(x) // capacity) for x in lengths], pa.int32()), pa.array(fits, pa.int32())], names=["shard", "least", "plain"])

    bounds = shards.select("shard", F.transform("items", lambda x: x["length"]).alias("lengths")).mapInArrow(plain, "shard long, least int, plain int")
    return bounds.join(best, "shard").select("shard", F.col("best.n").alias("sequences"), "best.made", "least", "plain")


def pack(parts: DataFrame, capacity: int = CAPACITY, files: int | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every row of ``parts``.

    Rows need a length from 1 to ``capacity``. Rows of equal values are packed each by
    itself, and dealt into different shards; no rows give no sequences. Shards take their
    pieces in sorted order, so ties have one order and a task that runs again gives the
    same packing (steps are written as ``files`` files at most); another cut of the table into files may give another, as good one.
    """
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    first = written(_pack(written(parts.select(*columns), "pieces", files), capacity, files), "packed", files)
    full = first.filter(F.col("fill") >= NEARLY_FULL * capacity)
    second = _pack(written(first.filter(F.col("fill") < NEARLY_FULL * capacity).select(*columns), "pieces", files), capacity, files)
    name = lambda level: F.shiftleft((F.col("shard") * 2 + level).cast("long"), 20) + F.col("group")
    return full.select(*columns, name(0).alias("sequence_id"), "offset").union(second.select(*columns, name(1).alias("sequence_id"), "offset"))


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, tokenizer: str | None = None, end: int = END) -> DataFrame:
    """Pieces of all documents with their sequence and their place in it."""
    return pack(pieces(docs, doc_id, text, capacity, tokenizer, end), capacity, files_for(docs))


def sequences(docs: DataFrame, packed: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, tokenizer: str | None = None, end: int = END) -> DataFrame:
    """The packed token ids themselves: sequence_id, length, ids (little-endian 32-bit), from documents whose ids are not repeated."""
    ids = pieces(docs, doc_id, text, capacity, tokenizer, end, with_ids=True).select("doc_id", "piece", "ids")
    rows = packed.join(ids, ["doc_id", "piece"])
    return rows.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("x")).select(
        "sequence_id", "length", F.aggregate("x", F.lit(b""), lambda a, b: F.concat(a, b["ids"])).alias("ids")
    )
