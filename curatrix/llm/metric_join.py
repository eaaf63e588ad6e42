"""Embedding near-dedup: an exact range join in the metric space of angles.

Angles between vectors are a metric; pairs of a cosine of ``cosine`` or more are those
within its arc cosine, the range. Equal vectors are first made one class with a count.

Pivots, of a bounded sample, part the classes into cells: a class within half the range of
a dense pivot is in that pivot's core, any other in the cell of the nearest background
pivot. By the triangle inequality all of a core are linked with each other, so its pairs
are never compared; and a class can only have partners in a cell if its angle to that
cell's pivot is between the cell's least and greatest less and plus the range, and (for
background cells) exceeds its least angle to any background pivot by no more than twice
the range. Where that holds it is replicated there, from later cells to earlier ones, so
that each pair meets once. Which pivots are taken changes the work, never the result.

Cells join by themselves, in units of a block of their own classes and a block of others,
so that a cell that holds a third of all vectors is many units. A unit returns, for each
class with links, their number and the first class it is connected with; no pair leaves a
task. Angles are compared with a slack of 1e-6, links by the cosine in doubles.

In many dimensions most unrelated vectors are about a right angle apart and no pivot parts
them: the background is then compared with itself in blocks, quadratic work that an exact
join of spread vectors can't escape; groups of near copies cost what their cores hold.

Vectors that are null, empty, zero, or hold nulls or numbers that are not finite are linked
with nothing, nor are vectors of different lengths. Rows with a null vec_id take no part:
no links, no component, kept. Rows that repeat a vec_id are vectors of their own. Other
columns (labels too) are not read, whatever their names. An empty table has no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import reachable, tidy, tidy_stream, written
from .graph import components

#: Vectors that pivots are chosen from, and cores and background cells at most.
SAMPLE, CORES, BACKGROUND = 2_000, 256, 256
#: Classes in a block at least, and bytes of its unit vectors at most; between them a table is ``PARTS`` blocks, as each class is sent to half of them.
LEAST, MOST_BYTES, PARTS = 1_024, 32 << 20, 8
#: Sampled vectors that make a core.
DENSE = 3
SLACK = 1e-6
#: Rows of a block compared at once, and rows dealt at once.
STEP, DEAL = 128, 2_000


def _matrices(column: pa.Array):
    """(rows, matrix of doubles) for each length of the column's vectors that are not null."""
    n = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64())
    values = np.where(flat.is_null().to_numpy(zero_copy_only=False), np.nan, flat.fill_null(0).to_numpy(zero_copy_only=False)) if flat.null_count else flat.to_numpy(zero_copy_only=False)
    at = np.cumsum(n) - n
    for length in np.unique(n[n > 0]):
        rows = np.flatnonzero(n == length)
        yield rows, values[at[rows][:, None] + np.arange(length)]


def units(m: np.ndarray) -> np.ndarray:
    """The rows of ``m`` as unit vectors of doubles."""
    m = m.astype(np.float64)
    m /= np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _packed(kind: str):
    """Vectors as bytes, null where they can't be linked."""

    def each(batches):
        for batch in batches:
            out: list[bytes | None] = [None] * batch.num_rows
            for rows, m in _matrices(batch.column(1)):
                good = np.isfinite(m).all(axis=1) & (m != 0).any(axis=1)
                for i, v in zip(rows[good], m[good].astype(kind), strict=True):
                    out[i] = v.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["vec_id", "v"])

    return each


def _units_of(column: pa.Array | pa.ChunkedArray, kind: str) -> np.ndarray:
    """Unit vectors of packed ones of one length."""
    held = column.to_pylist()
    return units(np.frombuffer(b"".join(held), kind).reshape(len(held), -1))


class Pivots:
    """Pivots of one length of vectors, and the cells they make: cores first."""

    def __init__(self, sample: np.ndarray, n_background: int, reach: float):
        self.reach, self.half = reach, reach / 2 - SLACK
        near = sample @ sample.T >= (math.cos(self.half) if self.half > 0 else 2)
        free, cores = np.ones(len(sample), bool), []
        while len(cores) < CORES:
            counts = (near & free).sum(axis=1) * free
            i = int(np.argmax(counts))
            if counts[i] < DENSE:
                break
            centre = sample[near[i] & free].mean(axis=0)
            centre /= np.linalg.norm(centre)
            cores.append(centre)
            free &= ~near[i] & (sample @ centre < math.cos(self.half))
        self.cores = np.array(cores).reshape(len(cores), sample.shape[1])
        rest = sample[free] if free.any() else sample
        chosen, far = [0], rest @ rest[0]
        while len(chosen) < min(n_background, len(rest)):
            i = int(np.argmin(far))
            chosen.append(i)
            far = np.maximum(far, rest @ rest[i])
        self.all = np.concatenate([self.cores, rest[chosen]])

    def angles(self, u: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(u @ self.all.T, -1, 1))

    def homes(self, angles: np.ndarray) -> np.ndarray:
        k, rows = len(self.cores), np.arange(len(angles))
        out = k + np.argmin(angles[:, k:], axis=1)
        if k:
            core = np.argmin(angles[:, :k], axis=1)
            out = np.where(angles[rows, core] <= self.half, core, out)
        return out

    def others(self, angles: np.ndarray, homes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which earlier cells (of least and greatest angles ``low`` and ``high``) may hold partners."""
        k, slack = len(self.cores), self.reach + SLACK
        out = (angles >= low - slack) & (angles <= high + slack) & (np.arange(len(self.all)) < homes[:, None])
        out[:, k:] &= angles[:, k:] <= angles[:, k:].min(axis=1, keepdims=True) + 2 * slack
        return out


def _by_length(column: pa.Array, pivots: dict[int, Pivots], kind: str):
    """(length, rows, unit vectors, pivots or None) for each length of a column of packed vectors."""
    lengths = pc.binary_length(column).to_numpy(zero_copy_only=False) // np.dtype(kind).itemsize
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield int(length), rows, _units_of(column.take(pa.array(rows)), kind), pivots.get(int(length))


def _homes(pivots: dict[int, Pivots], kind: str):
    """Each class's length, cell and angle to the cell's pivot. A length that has no pivots is one cell."""

    def each(batches):
        for batch in batches:
            length, cell, angle = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            for n, rows, u, p in _by_length(batch.column("v"), pivots, kind):
                length[rows] = n
                if p:
                    angles = p.angles(u)
                    cell[rows] = homes = p.homes(angles)
                    angle[rows] = angles[np.arange(len(rows)), homes]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("cls", "n", "v")), pa.array(length), pa.array(cell), pa.array(angle)], names=["cls", "n", "v", "length", "cell", "angle"])

    return each


class Cells:
    """Bounds and block counts of the cells of one length."""

    def __init__(self, n: int):
        self.low, self.high = np.full(n, np.inf), np.full(n, -np.inf)
        self.size, self.guests = np.zeros(n, np.int64), np.zeros(n, np.int64)

    def blocks(self, block: int) -> tuple[np.ndarray, np.ndarray]:
        return -(-self.size // block), -(-self.guests // block)


def _guests(pivots: dict[int, Pivots], cells: dict[int, Cells], kind: str):
    """How many classes of other cells each cell is given; a row a cell and task."""

    def each(batches):
        counts = {n: np.zeros(len(p.all), np.int64) for n, p in pivots.items()}
        for batch in batches:
            for n, rows, u, p in _by_length(batch.column("v"), pivots, kind):
                if p:
                    angles = p.angles(u)
                    counts[n] += p.others(angles, batch.column("cell").to_numpy()[rows], cells[n].low, cells[n].high).sum(axis=0)
        rows = [(n, c, int(k)) for n, x in counts.items() for c, k in enumerate(x) if k]
        yield pa.RecordBatch.from_pylist([{"length": a, "cell": b, "guests": c} for a, b, c in rows], schema=pa.schema([("length", pa.int32()), ("cell", pa.int32()), ("guests", pa.int64())]))

    return each


def _places(p: Pivots | None, cells: Cells, u: np.ndarray, homes: np.ndarray, salt: np.ndarray, block: int):
    """(rows, cell, i, j, right) of every unit that the classes take part in: block i of the cell's own against its block j, or from the own blocks' number on, against a block of guests."""
    own_blocks, guest_blocks = cells.blocks(block)
    cores = len(p.cores) if p else 0
    for c in np.unique(homes):
        rows = np.flatnonzero(homes == c)
        mine = salt[rows] % own_blocks[c]
        for j in range(own_blocks[c] if c >= cores else 0):
            yield rows, c, np.minimum(mine, j), np.maximum(mine, j), mine > j
        for g in range(guest_blocks[c]):
            yield rows, c, mine, np.full(len(rows), own_blocks[c] + g), np.zeros(len(rows), bool)
    if p:
        rows, to = np.nonzero(p.others(p.angles(u), homes, cells.low, cells.high))
        for c in np.unique(to):
            sent = rows[to == c]
            part = own_blocks[c] + (salt[sent] // 7919) % max(guest_blocks[c], 1)
            for i in range(own_blocks[c]):
                yield sent, c, np.full(len(sent), i), part, np.ones(len(sent), bool)


_UNIT = "length int, cell int, i int, j int, other boolean, cls long, n long, v binary"


def _dealt(pivots: dict[int, Pivots], cells: dict[int, Cells], kind: str, block: int):
    def each(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, DEAL):
                part = batch.slice(a, DEAL)
                cls, homes = part.column("cls").to_numpy(), part.column("cell").to_numpy()
                salt = (cls.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)).astype(np.int64)
                for n, rows, u, p in _by_length(part.column("v"), pivots, kind):
                    for own, c, i, j, other in _places(p, cells[n], u, homes[rows], salt[rows], block):
                        k, at = len(own), pa.array(rows[own])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(k, n, np.int32)), pa.array(np.full(k, c, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(other), part.column("cls").take(at), part.column("n").take(at), part.column("v").take(at)],
                            names=["length", "cell", "i", "j", "other", "cls", "n", "v"],
                        )

    return each


def _rooted(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if (up == parent).all():
            return up
        parent = up


def compare(a: np.ndarray, b: np.ndarray | None, n_a: np.ndarray, n_b: np.ndarray | None, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of each row of ``a`` and of ``b`` (None: among ``a``), weighted by counts, and the first place that each is connected with (places of b follow those of a)."""
    alone = b is None
    b, n_b = (a, n_a) if alone else (b, n_b)
    offset = 0 if alone else len(a)
    of_a, of_b, parent = np.zeros(len(a), np.int64), np.zeros(0 if alone else len(b), np.int64), np.arange(len(a) + (0 if alone else len(b)))
    for at in range(0, len(a), STEP):
        linked = a[at : at + STEP] @ b.T >= cosine
        if alone:
            k = np.arange(len(linked))
            linked[k, at + k] = False
        x, y = np.nonzero(linked)
        if not len(x):
            continue
        x += at
        of_a += np.bincount(x, n_b[y], len(a)).astype(np.int64)
        if not alone:
            of_b += np.bincount(y, n_a[x], len(b)).astype(np.int64)
        y += offset
        while True:
            p, q = parent[x], parent[y]
            apart = p != q
            if not apart.any():
                break
            x, y, p, q = x[apart], y[apart], p[apart], q[apart]
            np.minimum.at(parent, np.maximum(p, q), np.minimum(p, q))
            parent = _rooted(parent)
    return of_a, of_b, parent


def _joined(kind: str, cosine: float):
    def each(table: pa.Table) -> pa.Table:
        table = table.sort_by([("other", "ascending"), ("cls", "ascending")])
        other = table.column("other").to_numpy(zero_copy_only=False)
        k, cls, n = int((~other).sum()), table.column("cls").to_numpy(), table.column("n").to_numpy()
        u = _units_of(table.column("v"), kind)
        if k == len(cls):
            alone = table.column("i")[0] == table.column("j")[0]
            of_a, of_b, parent = compare(u, None if alone else u[:0], n, None if alone else n[:0], cosine)
        else:
            of_a, of_b, parent = compare(u[:k], u[k:], n[:k], n[k:], cosine)
        links = np.concatenate([of_a, of_b])
        held = np.flatnonzero(links)
        return pa.table({"cls": cls[held], "links": links[held], "root": cls[parent[held]]})

    return each


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", cosine: float = 0.95, block: int | None = None, sample: int = SAMPLE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors``: links are pairs of cosine ``cosine`` (over 0, at most 1) or more.

    ``block`` bounds the classes a task compares (None: by their number and length, see ``PARTS``), ``sample`` the vectors that pivots are chosen from.
    """
    if not 0 < cosine <= 1:
        raise ValueError("cosine has to be over 0 and at most 1")
    spark = reachable(vectors.sparkSession)
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("e"))
    kind = "f4" if rows.schema["e"].dataType.elementType.simpleString() == "float" else "f8"
    packed = rows.mapInArrow(tidy_stream(_packed(kind)), "vec_id long, v binary").withColumn("key", F.sha2("v", 256))
    some = packed.filter("v IS NOT NULL AND vec_id IS NOT NULL")
    classes = written(some.groupBy("key", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")).withColumn("cls", F.monotonically_increasing_id()), "classes")
    total = classes.count()
    drawn = [bytes(r.v) for r in classes.select("v").orderBy(F.xxhash64("v"), "v").limit(sample).collect()]
    longest = max(1, max(map(len, drawn), default=0) // np.dtype(kind).itemsize)
    block = block or min(max(total // PARTS, LEAST), max(MOST_BYTES // (8 * longest), LEAST))
    pivots = _pivots(drawn, total, kind, block, math.acos(cosine))
    # written, as a class on a border has to have the same home in all that follows
    homes = written(classes.select("cls", "n", "v").mapInArrow(tidy_stream(_homes(pivots, kind)), "cls long, n long, v binary, length int, cell int, angle double"), "homes")
    cells: dict[int, Cells] = {}
    bounds = homes.groupBy("length", "cell").agg(F.count("*").alias("size"), F.min("angle").alias("low"), F.max("angle").alias("high"), F.min("cls").alias("first"), F.sum("n").alias("n")).collect()  # a row a cell
    for r in bounds:
        held = cells.setdefault(r.length, Cells(len(pivots[r.length].all) if r.length in pivots else 1))
        held.size[r.cell], held.low[r.cell], held.high[r.cell] = r.size, r.low, r.high
    for r in homes.mapInArrow(tidy_stream(_guests(pivots, cells, kind)), "length int, cell int, guests long").groupBy("length", "cell").agg(F.sum("guests").alias("guests")).collect():
        cells[r.length].guests[r.cell] = r.guests
    met = homes.mapInArrow(tidy_stream(_dealt(pivots, cells, kind, block)), _UNIT).groupBy("length", "cell", "i", "j")
    found = written(met.applyInArrow(tidy(_joined(kind, cosine)), "cls long, links long, root long"), "links")
    cores = [(r.length, r.cell, r.first, r.n) for r in bounds if r.length in pivots and r.cell < len(pivots[r.length].cores) and r.size > 1]
    cores = spark.createDataFrame(cores, "length int, cell int, root long, total long")
    inner = homes.join(F.broadcast(cores), ["length", "cell"]).select("cls", (F.col("total") - F.col("n")).alias("links"), "root")
    each = found.union(inner)
    joined = components(each.select(F.col("cls").alias("u"), F.col("root").alias("v")))
    counts = each.groupBy("cls").agg(F.sum("links").alias("links"))
    named = joined.withColumnRenamed("node", "cls").join(classes.select("cls", "rep"), "cls")
    least = named.groupBy("component").agg(F.min("rep").alias("least"))
    labels = named.join(least, "component").select("cls", "least")
    judged = classes.select("key", "rep", "n", "cls").join(counts, "cls", "left").join(labels, "cls", "left")
    judged = judged.select("key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("least", "rep").alias("least"))
    out = packed.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("key")).alias("key")).join(judged, "key", "left")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("least", "vec_id").alias("component_id"), F.coalesce(F.col("vec_id") == F.coalesce("least", "vec_id"), F.lit(True)).alias("kept"))


def _pivots(drawn: list[bytes], total: int, kind: str, block: int, reach: float) -> dict[int, Pivots]:
    """Pivots for each length of the vectors drawn of ``total`` classes."""
    by: dict[int, list[bytes]] = {}
    for v in drawn:
        by.setdefault(len(v) // np.dtype(kind).itemsize, []).append(v)
    out = {}
    for n, held in by.items():
        wanted = min(BACKGROUND, max(1, math.ceil(total * len(held) / len(drawn) / block)))
        out[n] = Pivots(units(np.frombuffer(b"".join(held), kind).reshape(len(held), -1)), wanted, reach)
    return out
