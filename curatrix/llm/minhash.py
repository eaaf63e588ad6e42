"""MinHash near-dedup by fast similarity sketching, banding and exact verification.

Sketch. A set's elements are thrown into t bins in rounds: in rounds 0 to t - 1 an
element's bin is hashed, in round t + b every element goes to bin b. A bin keeps its
smallest (round, hash); a set is done once all its bins are filled, which round 2 t - 1
guarantees. Two sets agree in a bin with the probability of their similarity, with
concentration as of independent hashes, while a set of many elements needs one round.

Banding. Sets that agree in all bins of a band are candidates. The threshold gives the
widest bands, of 5 bins at most, by which two sets of just that similarity share none with
odds below 1e-6: 25 of 5 at 0.85 (4e-7), 32 of 4 at 0.80 (5e-8). Below 0.11 bands of one
bin miss more.

Verification. Copies (equal sets) are first reduced to their smallest id. Components of
the candidates are then worked on in blocks: a block holds full sets, and a breadth-first
search compares each set reached with all sets not yet reached, so no pair is emitted and
no link between different texts is lost. A component of more shingles than a block is
split: blocks find their own components; a root of each meets all blocks of its candidate
component; and all members of what is then still apart from the largest meet all blocks.
Two sets in different results have thus been compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import files_for, tidy, tidy_stream, written
from .graph import components
from .hashing import ODD, U, mix, raw, shingles, slices

BINS, BANDS, ROWS = 128, 25, 5
#: Odds below which a pair at the threshold may share no band.
MISSED = 1e-6
#: Shingles in a block, where 8 bytes of text count as one at least; of longer documents a block has one.
BLOCK = 1_000_000
#: Characters of probes that meet a block at once.
PROBES = 8_000_000
#: Bytes of text worked on at once.
STEP = 1_000_000
_SEEDS = mix(np.arange(1, 2 * BINS + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
_EMPTY = U(0xFFFFFFFFFFFFFFFF)


def sketches(values: np.ndarray, offsets: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Fast similarity sketches of the sets ``values[offsets[i]:offsets[i+1]]``; a row of all ones is the empty set's."""
    n = len(offsets) - 1
    out = np.full((n, bins), _EMPTY, np.uint64)
    flat = out.reshape(-1)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    for r in range(2 * bins):
        if not len(values):
            break
        h = mix(values ^ _SEEDS[r])
        to = (h & U(bins - 1)).astype(np.int64) if r < bins else r - bins
        np.minimum.at(flat, owner * bins + to, (U(r) << U(56)) | (h >> U(8)))
        if r % 4 == 3 or r < 4:
            open_ = (out == _EMPTY).any(axis=1)
            left = open_[owner]
            if not left.all():
                values, owner = values[left], owner[left]
    return out


def banding(percent: int) -> tuple[int, int]:
    """Number and width of the bands for pairs of a similarity of ``percent`` or more."""
    for rows in range(ROWS, 1, -1):
        if (1 - (percent / 100) ** rows) ** (BINS // rows) < MISSED:
            return BINS // rows, rows
    return BINS, 1


def bands(sketch: np.ndarray, n: int = BANDS, rows: int = ROWS) -> np.ndarray:
    out = np.empty((len(sketch), n), np.uint64)
    for b in range(n):
        part = sketch[:, b * rows : (b + 1) * rows]
        out[:, b] = mix((part * ODD[:rows]).sum(axis=1, dtype=np.uint64) + U(b * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    return out


def _sketch_batches(percent: int):
    n_bands, rows = banding(percent)

    def each(batches):
        for batch in batches:
            _, offsets = raw(batch.column(1))
            for a, b in slices(offsets, STEP):
                values, at = shingles(batch.column(1).slice(a, b - a))
                n = np.diff(at)
                keys = np.concatenate([[0], np.cumsum(mix(values * ODD[50]), dtype=np.uint64)])
                other = np.concatenate([[0], np.cumsum(mix(values ^ ODD[51]), dtype=np.uint64)])
                found = bands(sketches(values, at), n_bands, rows).view(np.int64)
                full = np.flatnonzero(n)
                sizes = np.zeros(b - a + 1, np.int32)
                sizes[1:] = np.where(n > 0, n_bands, 0)
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes, dtype=np.int32)), pa.array(found[full].reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n), pa.array(np.diff(offsets[a : b + 1])), pa.array((keys[at[1:]] - keys[at[:-1]]).view(np.int64)), pa.array((other[at[1:]] - other[at[:-1]]).view(np.int64)), lists],
                    names=["doc_id", "n_shingles", "n_bytes", "set_a", "set_b", "bands"],
                )

    return each


def linked(inter: np.ndarray, a: int, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * inter >= percent * (a + b - inter)


class Block:
    """Full sets side by side; finds what is linked with one of them."""

    def __init__(self, values: np.ndarray, offsets: np.ndarray):
        self.offsets, self.sizes = offsets, np.diff(offsets)
        order = np.argsort(values)
        ordered = values[order]
        fresh = np.ones(len(values), bool)
        fresh[1:] = ordered[1:] != ordered[:-1]
        self.ids = np.empty(len(values), np.int32)
        self.ids[order] = np.cumsum(fresh, dtype=np.int32) - 1
        self.owners = np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)[order]
        self.places = np.append(np.flatnonzero(fresh), len(values))
        self.mark = np.zeros(len(self.places), np.int32)

    def links(self, u: int, among: np.ndarray, percent: int) -> np.ndarray:
        """Those of ``among`` that are linked with set u. Counts by the shorter of two ways: u's postings, or the sets asked for."""
        n = int(self.sizes[u])
        sizes = self.sizes[among]
        among = among[(100 * np.minimum(sizes, n) >= percent * np.maximum(sizes, n)) & (sizes > 0)]
        if not len(among) or not n:
            return among[:0]
        own = self.ids[self.offsets[u] : self.offsets[u + 1]]
        a, b = self.places[own], self.places[own + 1]
        if int((b - a).sum()) <= int(self.sizes[among].sum()):
            inter = np.bincount(np.concatenate([self.owners[x:y] for x, y in zip(a, b, strict=True)]), minlength=len(self.sizes))[among]
        else:
            self.mark[own] = 1
            if len(among) == len(self.sizes):
                inter = np.add.reduceat(self.mark[self.ids], self.offsets[:-1])
            else:
                counts = self.sizes[among]
                ends = np.cumsum(counts)
                index = np.arange(int(ends[-1])) + np.repeat(self.offsets[among] - (ends - counts), counts)
                inter = np.add.reduceat(self.mark[self.ids[index]], ends - counts)
            self.mark[own] = 0
        return among[linked(inter, n, self.sizes[among], percent)]

    def search(self, percent: int) -> np.ndarray:
        """The first set of each set's component, in the order given."""
        label = np.full(len(self.sizes), -1)
        left = np.arange(len(self.sizes))
        while len(left):
            root, left = left[0], left[1:]
            label[root] = root
            queue = [root]
            while queue and len(left):
                found = self.links(queue.pop(), left, percent)
                if len(found):
                    label[found] = root
                    queue.extend(found)
                    left = left[label[left] < 0]
        return label


def _sets(table: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
    """The sets of a column's texts; ``STEP`` bytes are hashed at a time, as that takes many times their size."""
    values, sizes = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for chunk in table.column(column).chunks:
        for a, b in slices(raw(chunk)[1], STEP):
            found, at = shingles(chunk.slice(a, b - a))
            values.append(found)
            sizes.append(np.diff(at))
    return np.concatenate(values), np.cumsum(np.concatenate(sizes))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 85, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, for every row of ``docs``.

    Words are A-Z lower-cased and split at white space; shingles are of five words.
    Null and empty texts have no shingles and are linked with nothing. Rows with a null
    doc_id take no part in linking: their component is null and they are kept. Repeated
    doc_ids are one document for linking. Other columns are not read.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    files = files_for(docs)
    sketched = written(rows.mapInArrow(tidy_stream(_sketch_batches(percent)), "doc_id long, n_shingles long, n_bytes long, set_a long, set_b long, bands array<long>"), "sketches", files)
    full = sketched.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    sets = full.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("rep"))
    reps = sets.join(full.select(F.col("doc_id").alias("rep"), "set_a", "set_b", "n_bytes", "bands"), ["rep", "set_a", "set_b"]).select("rep", F.greatest("n_shingles", F.col("n_bytes") / 8).cast("long").alias("weight"), "bands")
    dealt = reps.select("rep", F.posexplode("bands").alias("band", "hash"))
    least = dealt.groupBy("band", "hash").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).filter("least != most").drop("most")
    candidates = components(dealt.join(least, ["band", "hash"]).filter("rep != least").select(F.col("rep").alias("u"), F.col("least").alias("v")), files=files)
    groups = candidates.withColumnRenamed("node", "rep").join(reps.select("rep", "weight"), "rep")
    sizes = groups.groupBy("component").agg(F.sum("weight").alias("total")).select("component", F.ceil(F.col("total") / block).cast("int").alias("n_blocks"))
    groups = groups.dropDuplicates(["rep"]).join(sizes, "component").select("rep", "component", "n_blocks", F.pmod(F.xxhash64("rep"), F.col("n_blocks")).cast("int").alias("block"))
    texts = groups.join(rows.withColumnRenamed("doc_id", "rep"), "rep")

    def search(table: pa.Table) -> pa.Table:
        table = table.sort_by("rep")
        label = Block(*_sets(table, "text")).search(percent)
        reps_ = table.column("rep").to_numpy()
        return pa.table({"rep": reps_, "label": reps_[label], "component": table.column("component"), "n_blocks": table.column("n_blocks"), "block": table.column("block")})

    found = written(texts.groupBy("component", "block").applyInArrow(tidy(search), "rep long, label long, component long, n_blocks int, block int"), "links", files)
    labels = found.select("rep", "label")
    split = found.filter("n_blocks > 1")
    if split.head(1):
        labels = _join_blocks(labels, split, rows, percent, files)
    moved = labels.filter("rep != label").distinct()
    if moved.groupBy("rep").count().filter("count > 1").head(1):  # ids that stand for several texts
        moved = components(moved.withColumnsRenamed({"rep": "u", "label": "v"}), files=files).withColumnsRenamed({"node": "rep", "component": "label"})
    named = sets.join(moved, "rep", "left").select("set_a", "set_b", "n_shingles", F.coalesce("label", "rep").alias("found"))
    out = sketched.select("doc_id", "n_shingles", "set_a", "set_b").join(named, ["set_a", "set_b", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce(F.when(F.col("n_shingles") > 0, F.col("found")), F.col("doc_id")))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _join_blocks(labels: DataFrame, split: DataFrame, rows: DataFrame, percent: int, files: int) -> DataFrame:
    """Labels over the blocks of candidate components that were split."""
    members = written(split.join(rows.withColumnRenamed("doc_id", "rep"), "rep"), "members", files)
    roots = members.filter("rep = label")
    first = components(_meet(roots, members, percent), files=files)
    roots_now = first.select(F.col("node").alias("label"), F.col("component").alias("root"))
    now = members.join(roots_now, "label", "left").withColumn("now", F.coalesce("root", "label"))
    counts = now.groupBy("component", "now").agg(F.count("*").alias("n"))
    largest = counts.groupBy("component").agg(F.max_by("now", F.struct("n", "now")).alias("largest"))
    apart = now.join(largest, "component").filter("now != largest")
    edges = first.select(F.col("node").alias("u"), F.col("component").alias("v")).union(_meet(apart, members, percent))
    final = components(edges, files=files)
    return labels.join(final.select(F.col("node").alias("label"), F.col("component").alias("root")), "label", "left").select("rep", F.coalesce("root", "label").alias("label"))


def _meet(probes: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Edges (u, v) between the labels of probes and of the members they are linked with, over all blocks of their candidate component.

    Probes are dealt into blocks of their own, of at most ``PROBES`` characters in the mean,
    so that a task holds a block of members and a block of probes.
    """
    totals = probes.groupBy("component").agg(F.ceil(F.sum(F.length("text")) / PROBES).cast("int").alias("n_probes"))
    p = probes.join(totals, "component").withColumn("part", F.pmod(F.xxhash64("rep", F.lit(1)), F.greatest("n_probes", F.lit(1))).cast("int"))
    p = p.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))).select("component", "block", "part", "rep", "label", "text", F.lit(True).alias("probe"))
    m = members.join(totals, "component").withColumn("part", F.explode(F.sequence(F.lit(0), F.greatest("n_probes", F.lit(1)) - 1)))
    m = m.select("component", "block", "part", "rep", "label", "text", F.lit(False).alias("probe"))

    def meet(table: pa.Table) -> pa.Table:
        probe = table.column("probe").to_numpy(zero_copy_only=False)
        label = table.column("label").to_numpy()
        block = Block(*_sets(table, "text"))
        others = np.flatnonzero(~probe)
        edges = set()
        for u in np.flatnonzero(probe):
            among = others[label[others] != label[u]]
            edges.update((int(label[u]), int(x)) for x in np.unique(label[block.links(int(u), among, percent)]))
        return pa.table({"u": pa.array([e[0] for e in edges], pa.int64()), "v": pa.array([e[1] for e in edges], pa.int64())})

    return p.union(m).groupBy("component", "block", "part").applyInArrow(tidy(meet), "u long, v long")
