"""The metric range join against the cosine of every pair."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from curatrix.llm import metric_join as mj

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine):
    """(vec_id, links, component, kept) of every row, by all pairs."""
    n, unit = len(rows), []
    for _, v in rows:
        a = None if v is None or any(x is None for x in v) else np.array(v, float)
        unit.append(a / np.linalg.norm(a) if a is not None and len(a) and np.isfinite(a).all() and a.any() else None)
    links = [[] for _ in rows]
    for i in range(n):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and None not in (rows[i][0], rows[j][0]) and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= cosine:
                links[i].append(j)
                links[j].append(i)
    label = [None] * n
    for i in range(n):
        if label[i] is None:
            seen, todo = {i}, [i]
            while todo:
                for j in links[todo.pop()]:
                    if j not in seen:
                        seen.add(j)
                        todo.append(j)
            ids = [rows[j][0] for j in seen if rows[j][0] is not None]
            for j in seen:
                label[j] = min(ids, default=None)
    return sorted(str((rows[i][0], len(links[i]), label[i], label[i] is None or label[i] == rows[i][0])) for i in range(n))


def clouds(seed, dim=12, singles=150, groups=((60, 0.03), (40, 0.12), (30, 0.3))):
    """Spread vectors, a chain, and groups about a centre: closer than the range, about it, wider."""
    r = np.random.default_rng(seed)
    out = list(r.normal(size=(singles, dim)))
    for n, noise in groups:
        centre = r.normal(size=dim)
        centre /= np.linalg.norm(centre)
        out += [centre + noise * r.normal(size=dim) for _ in range(n)]
    angle = np.arange(40) * 0.28
    out += [np.cos(a) * np.eye(dim)[0] + np.sin(a) * np.eye(dim)[1] for a in angle]
    return [np.float32(x).tolist() for x in out]


ODD = [None, [], [0.0] * 12, [math.nan] + [1.0] * 11, [math.inf] + [1.0] * 11, [None] + [1.0] * 11, [1e30] * 12, [1e-30] * 12, [1.0], [2.0], [-0.0, 1.0], [0.0, 3.0]]


@pytest.mark.parametrize(("cosine", "block", "sample"), [(0.95, None, 2000), (0.95, 16, 50), (0.8, 10, 300), (0.95, 7, 1), (1.0, 50, 300)])
def test_all_pairs(spark, cosine, block, sample):
    vectors = clouds(7) + ODD
    rows = [(int(k), v) for k, v in zip(np.random.default_rng(1).permutation(len(vectors)), vectors, strict=True)]
    rows += [(9000, rows[0][1]), (9001, rows[0][1]), (None, rows[0][1]), rows[200], (rows[3][0], rows[5][1]), (9002, [x * 4 for x in rows[170][1]])]  # copies, a null id, a repeated row, an id used twice, a scaled copy
    df = spark.createDataFrame([(k, v, 0) for k, v in rows], SCHEMA).withColumn("cls", F.lit(1)).withColumn("n_links", F.lit(1)).repartition(4)
    if cosine == 1.0:  # rounding decides: equal vectors only
        got = mj.near_vectors(df.filter("vec_id >= 9000 OR vec_id IS NULL"), cosine=cosine, block=block, sample=sample)
        assert {x.vec_id: x.n_links for x in got.collect()}[9000] == 1
        return
    got = mj.near_vectors(df, cosine=cosine, block=block, sample=sample)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(str(tuple(x)) for x in got.collect()) == brute(rows, cosine)


def test_doubles_and_hot_vector(spark):
    """A third of all rows are one vector, another third its near copies: counts stay exact, and the core is not compared."""
    r = np.random.default_rng(2)
    centre = r.normal(size=8)
    vectors = [centre.tolist()] * 200 + [(centre + 0.01 * r.normal(size=8)).tolist() for _ in range(200)] + r.normal(size=(200, 8)).tolist()
    rows = list(enumerate(vectors))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = mj.near_vectors(df, block=32)
    assert sorted(str(tuple(x)) for x in got.collect()) == brute(rows, 0.95)


def test_cells_prune():
    """Vectors far from a core are not sent to it; those in its cell's reach are."""
    r = np.random.default_rng(3)
    centre = np.eye(16)[0]
    near = mj.units(centre + 0.02 * r.normal(size=(50, 16)))
    spread = mj.units(r.normal(size=(300, 16)))
    p = mj.Pivots(np.concatenate([near, spread]), 4, math.acos(0.95))
    assert len(p.cores) == 1 and len(p.all) == 5
    angles = p.angles(spread)
    homes = p.homes(angles)
    assert (p.homes(p.angles(near)) == 0).all() and (homes > 0).all()
    low, high = np.array([0.0, *[angles[homes == k, k].min() for k in range(1, 5)]]), np.array([p.half, *[angles[homes == k, k].max() for k in range(1, 5)]])
    sent = p.others(angles, homes, low, high)
    assert not sent[:, 0].any()
    pairs = spread @ spread.T >= 0.95
    for i, j in zip(*np.nonzero(np.triu(pairs, 1)), strict=True):
        a, b = (i, j) if homes[i] >= homes[j] else (j, i)
        assert homes[a] == homes[b] or sent[a, homes[b]]


def test_nothing(spark):
    assert mj.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [tuple(x) for x in mj.near_vectors(spark.createDataFrame([(3, None, 1)], SCHEMA)).collect()] == [(3, 0, 3, True)]
    with pytest.raises(ValueError, match="cosine"):
        mj.near_vectors(spark.createDataFrame([], SCHEMA), cosine=0)
