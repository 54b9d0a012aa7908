"""Exact cosine links of vectors by dual traversal of cover trees.

On unit vectors a cosine of at least s is a chord of at most ``sqrt(2 - 2 s)``. Vectors go
to the nearest of a bounded number of pivots; a cell of more than ``BLOCK`` vectors is
dealt into blocks at random. Each block gets a cover tree: nested levels of centres with
halving radii, each vector under a centre within its level's radius. A tree is kept as
each vector's path of child numbers, centres first, so a node is a run of rows.

Two blocks meet if their pivots' distance less both radii is within the bound; each such
pair, found by joins over the cells that may meet, and each block with itself, is a task. A pair of nodes is dropped when the
distance of their centres less both covering radii exceeds the bound, taken whole when
the distance plus both radii is within it, and else its children are paired. A pair taken
whole adds counts to both runs and ties them together without listing its links; so
output is a row for each vector and task. Single vectors are compared in double
precision. Bounds are loosened by more than rounding can amount to.

Where vectors have no nearer neighbours than chance gives, no bound can part them, and
the number of distances grows as the square of the vectors, in blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Union, by_group, components, written

BLOCK = 8192
PIVOTS = 1024
LEVELS = 7  # radii 1, 1/2 ... 1/64 below the root, whose ball of radius 2 holds all
#: Vectors that a ball of radius 1 must hold to be a node; those in lesser ones share one, whose radius is what it comes to.
WIDE = 32


def slack(dim: int) -> float:
    """More than rounding can add to a distance and two radii in double precision; it is largest near 0."""
    return 3 * math.sqrt(2 * (2 * dim + 8) * 1.2e-16)


def loose(dim: int) -> float:
    """More than rounding can take from a cosine and its bound in single precision."""
    return (dim + 32) * 6e-8


def grow(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the rows and, in that order, their paths (rows, LEVELS); each node's first row is its centre."""
    n = len(x)
    order = np.arange(n)
    path = np.zeros((n, LEVELS), np.int32)
    runs = [(0, n)]
    for level in range(LEVELS):
        least = 1 - (2.0**-level) ** 2 / 2  # the cosine at the level's radius
        nxt = []
        for lo, hi in runs:
            own = order[lo:hi]
            label = _greedy(x[own], least)
            if level == 0:
                # a wide ball of a few vectors parts nothing and costs a bound of its own
                label = np.where(np.bincount(label)[label] < min(WIDE, len(own)), label.max() + 1, label)
            at = np.argsort(label, kind="stable")
            order[lo:hi] = own[at]
            label = label[at]
            path[lo:hi, level] = label
            cuts = lo + np.concatenate([[0], np.flatnonzero(np.diff(label)) + 1, [hi - lo]])
            nxt += [(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if b - a > 1]
        # paths of earlier levels follow the rows: they are equal throughout a run
        runs = nxt
    return order, path


def _greedy(x: np.ndarray, least: float) -> np.ndarray:
    """Centre numbers: the first row is a centre; each row that no centre covers becomes one."""
    n = len(x)
    label = np.full(n, -1, np.int32)
    k = 0
    left = np.arange(n)
    while len(left):
        batch = left[:256]
        c = x[batch] @ x[left].T >= least
        for i in range(len(batch)):
            if label[batch[i]] < 0:
                free = left[c[i]]
                free = free[label[free] < 0]
                label[free] = k
                label[batch[i]] = k
                k += 1
        left = left[label[left] < 0]
    return label


class Tree:
    """Nodes of all levels from rows in tree order: begin, end, level, covering radius, and each node's children as a run of nodes."""

    def __init__(self, x: np.ndarray, path: np.ndarray, weight: np.ndarray):
        n = len(x)
        self.x, self.single = x, x.astype(np.float32)
        begin, end, kids = [np.zeros(1, np.int64)], [np.full(1, n)], []
        change = np.zeros(n, bool)
        change[0] = True
        for level in range(LEVELS + 1):
            if level < LEVELS:
                change[1:] |= np.diff(path[:, level]) != 0
                b = np.flatnonzero(change)
            else:
                b = np.arange(n)  # the vectors themselves
            kids.append(np.searchsorted(b, np.append(begin[-1], n)))
            begin.append(b)
            end.append(np.append(b[1:], n))
        sizes = np.array([len(b) for b in begin])
        base = np.cumsum(sizes) - sizes
        self.begin, self.end = np.concatenate(begin), np.concatenate(end)
        first, last = [], []
        for level, k in enumerate(kids):
            first.append(k[:-1] + base[level + 1])
            last.append(k[1:] + base[level + 1])
        leaf = np.zeros(n, np.int64)
        self.first, self.last = np.concatenate([*first, leaf]), np.concatenate([*last, leaf])
        self.radius = np.zeros(len(self.begin))
        for level in range(LEVELS + 1):
            a = slice(base[level], base[level] + sizes[level])
            m = self.end[a] - self.begin[a]
            d2 = 2 - 2 * np.einsum("ij,ij->i", x, x[np.repeat(self.begin[a], m)])
            self.radius[a] = np.where(m > 1, np.sqrt(np.maximum(np.maximum.reduceat(d2, self.begin[a]), 0)), 0)
        total = np.concatenate([[0], np.cumsum(weight)])
        self.weight = total[self.end] - total[self.begin]


def dual(a: Tree, b: Tree, similarity: float):
    """Links between two trees, or within one: counts added to the rows of a and b, pairs of rows that link, pairs of nodes that link throughout."""
    bound = math.sqrt(2 - 2 * similarity)
    more_than = slack(a.x.shape[1])
    same = a is b
    singles, wholes = [], []
    todo = [(np.zeros(1, np.int64), np.zeros(1, np.int64))]

    def judge(i: np.ndarray, j: np.ndarray) -> None:
        """Node pairs to keep, take or expand."""
        if same:
            up = i <= j
            i, j = i[up], j[up]
        for lo in range(0, len(i), 200_000):
            p, q = i[lo : lo + 200_000], j[lo : lo + 200_000]
            cos = np.einsum("ij,ij->i", a.x[a.begin[p]], b.x[b.begin[q]])
            d = np.sqrt(np.maximum(2 - 2 * cos, 0))
            r = a.radius[p] + b.radius[q]
            one = (a.end[p] - a.begin[p] == 1) & (b.end[q] - b.begin[q] == 1)
            hit = one & (cos >= similarity)
            if same:
                hit &= p != q
            singles.append((a.begin[p[hit]], b.begin[q[hit]]))
            far = d - r > bound + more_than
            # a node with itself: any two of its vectors are within twice its radius
            near = ~one & (np.where((p == q) & same, r, d + r) <= bound - more_than)
            wholes.append((p[near], q[near]))
            more = ~one & ~far & ~near
            if more.any():
                todo.append((p[more], q[more]))

    while todo:
        i, j = todo.pop()
        # a node without children of its own (a vector) stands for itself
        fi, li = np.where(a.last[i] > a.first[i], a.first[i], i), np.where(a.last[i] > a.first[i], a.last[i], i + 1)
        fj, lj = np.where(b.last[j] > b.first[j], b.first[j], j), np.where(b.last[j] > b.first[j], b.last[j], j + 1)
        n = (li - fi) * (lj - fj)
        for k in np.flatnonzero(n > 4096):
            _dense(a, b, np.arange(fi[k], li[k]), np.arange(fj[k], lj[k]), bound + more_than, judge)
        small = np.flatnonzero(n <= 4096)
        cut = np.cumsum(n[small]) // 500_000
        for part in (small[cut == c] for c in np.unique(cut)):
            m = n[part]
            at = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
            width = np.repeat(lj[part] - fj[part], m)
            p, q = np.repeat(fi[part], m) + at // width, np.repeat(fj[part], m) + at % width
            judge(p, q)
    cat = lambda z: tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (zip(*z, strict=True) if z else ((), ())))
    return cat(singles), cat(wholes)


def _dense(a: Tree, b: Tree, p: np.ndarray, q: np.ndarray, bound: float, judge) -> None:
    """Of many node pairs at once, hands on those that a bound in single precision doesn't drop."""
    # nodes that are a vector, or copies of one, share one bound; few others are as near the root
    p, q = p[np.argsort(a.radius[p] > 0, kind="stable")], q[np.argsort(b.radius[q] > 0, kind="stable")]
    less = np.float32(loose(a.x.shape[1]))
    for lo in range(0, len(p), 2048):
        pp = p[lo : lo + 2048]
        x, rx = a.single[a.begin[pp]], a.radius[pp].astype(np.float32)
        for at in range(0, len(q), 2048):
            qq = q[at : at + 2048]
            ry = b.radius[qq].astype(np.float32)
            reach = np.float32(bound)
            if rx[-1] > 0 or ry[-1] > 0:
                reach = np.minimum(reach + rx[:, None] + ry[None], np.float32(2))
            i, j = np.nonzero(x @ b.single[b.begin[qq]].T >= 1 - reach * reach / 2 - less)
            if len(i):
                judge(pp[i], qq[j])


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow in the square
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _links(similarity: float):
    def work(g: pd.DataFrame) -> pd.DataFrame | None:
        ids, weight, side = g["rep"].to_numpy(), g["weight"].to_numpy(), g["side"].to_numpy()
        x = _unit(np.array(g["vector"].tolist()))
        path = np.array(g["path"].tolist(), np.int32).reshape(len(g), LEVELS)
        cut = int((side == 0).sum())
        own = g["own"].iloc[0]
        if not own and cut in (0, len(g)):
            return None
        a = Tree(x[:cut], path[:cut], weight[:cut]) if not own else Tree(x, path, weight)
        b = a if own else Tree(x[cut:], path[cut:], weight[cut:])
        shift = 0 if own else cut
        (si, sj), (wi, wj) = dual(a, b, similarity)
        n = len(g)
        links = np.rint(np.bincount(si, weight[sj + shift], n) + np.bincount(sj + shift, weight[si], n)).astype(np.int64)
        step, tied, alone = (np.zeros(n + 1, np.int64) for _ in range(3))
        once = wi == wj if own else np.zeros(len(wi), bool)  # a node with itself
        for t, u, p, q, at in ((a, b, wi, wj, 0), (b, a, wj[~once], wi[~once], shift)):
            np.add.at(step, t.begin[p] + at, u.weight[q])
            np.add.at(step, t.end[p] + at, -u.weight[q])
            np.add.at(tied, t.begin[p] + at, 1)
            np.add.at(tied, t.end[p] + at - 1, -1)
        np.add.at(alone, a.begin[wi[once]], 1)
        np.add.at(alone, a.end[wi[once]], -1)
        links += np.cumsum(step)[:n] - np.cumsum(alone)[:n] * weight
        forest = Union(n)
        for k in np.flatnonzero(np.cumsum(tied)[:n] > 0).tolist():
            forest.join(k, k + 1)
        for p, q in zip([*si.tolist(), *a.begin[wi].tolist()], [*(sj + shift).tolist(), *(b.begin[wj] + shift).tolist()], strict=True):
            forest.join(p, q)
        root = np.fromiter((forest.find(k) for k in range(n)), np.int64, n)
        least = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(least, root, ids)
        some = links > 0
        return pd.DataFrame({"rep": ids[some], "links": links[some], "root": least[root[some]]}) if some.any() else None

    return work


def near_vectors(rows: DataFrame, similarity: float = 0.9) -> DataFrame:
    """Per row of ``rows``: vec_id, n_links, component_id, kept.

    Vectors link if the cosine of their ``embedding`` in double precision is at least
    ``similarity``, and both have the same number of components. A vector that is null,
    empty or zero, or holds a null or non-finite component, has 0 links and is its own component.
    Equal vectors are compared once and count as often as they come. Rows that repeat a
    vec_id are one node, whose links are those of all its vectors; n_links is the
    row's own vector's. A row without vec_id takes no part: n_links and component_id are null and it is kept. Only
    vec_id and embedding are read.
    """
    spark = rows.sparkSession
    v = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    sound = F.col("vector").isNotNull() & (F.size("vector") > 0) & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    good = v.where("vec_id is not null").where(F.coalesce(sound, F.lit(False))).withColumn("h", F.struct(F.xxhash64("vector").alias("a"), F.xxhash64(F.lit(3), "vector").alias("b")))
    classes = written(good.groupBy("h").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight")), "vectors")
    member = good.select("vec_id", "h").join(classes, "h").select("vec_id", "rep", "weight", "h")
    reps = good.join(classes, "h").where("vec_id = rep").dropDuplicates(["h"]).select("rep", "weight", "vector")
    n = reps.count()
    few = reps.select("rep", "vector").orderBy(F.xxhash64("rep")).limit(min(PIVOTS, max(1, math.ceil(n / (BLOCK // 2))))).collect()
    pivots: dict[int, np.ndarray] = {}
    for d in {len(r.vector) for r in few}:
        pivots[d] = _unit(np.array([r.vector for r in few if len(r.vector) == d]))

    def reach(dim: int) -> float:
        return math.sqrt(2 - 2 * similarity) + slack(dim)

    def nearest(batches):
        for b in batches:
            x = b["vector"].tolist()
            dims = np.array([len(k) for k in x])
            cell, dist = np.zeros(len(b), np.int32), np.full(len(b), 2.0)
            for d in np.unique(dims):
                if int(d) in pivots:
                    at = np.flatnonzero(dims == d)
                    c = _unit(np.array([x[i] for i in at])) @ pivots[int(d)].T
                    cell[at] = c.argmax(1)
                    dist[at] = np.sqrt(np.maximum(2 - 2 * c.max(1), 0))
            yield b.assign(dim=dims.astype(np.int32), cell=cell, dist=dist)

    dealt = written(reps.mapInPandas(nearest, "rep long, weight long, vector array<double>, dim int, cell int, dist double"), "cells")
    parts = dealt.groupBy("dim", "cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    dealt = dealt.join(F.broadcast(parts), ["dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("rep", F.lit(5)), F.col("parts")).cast("int"))  # at most PIVOTS cells of each dimension

    def tree(g: pd.DataFrame) -> pd.DataFrame:
        order, path = grow(_unit(np.array(g["vector"].tolist())))
        return g.iloc[order].assign(path=list(path), place=np.arange(len(g), dtype=np.int32))

    trees = written(by_group(dealt.select("dim", "cell", "part", "rep", "weight", "vector", "dist"), ["dim", "cell", "part"], ["rep"], tree, "dim int, cell int, part int, rep long, weight long, vector array<double>, dist double, path array<int>, place int"), "trees")
    # which cells may hold vectors that link is settled here, at most PIVOTS ** 2 / 2 pairs; which of their blocks, by joins
    blocks = written(trees.groupBy("dim", "cell", "part").agg(F.max("dist").alias("radius")), "blocks")
    cells = blocks.groupBy("dim", "cell").agg(F.max("radius").alias("radius")).orderBy("dim", "cell").toPandas()
    near = []
    for d, g in cells.groupby("dim"):
        c, r = g["cell"].to_numpy(), g["radius"].to_numpy()
        gap = np.sqrt(np.maximum(2 - 2 * pivots[d] @ pivots[d].T, 0))[np.ix_(c, c)] if d in pivots else np.zeros((1, 1))
        np.fill_diagonal(gap, 0)
        i, j = np.nonzero(np.triu(gap - r[:, None] - r[None] <= reach(d)))
        near.append(pd.DataFrame({"dim": np.full(len(i), d, np.int32), "c1": c[i], "c2": c[j], "gap": gap[i, j]}))
    pairs = spark.createDataFrame(pd.concat(near), "dim int, c1 int, c2 int, gap double") if near else spark.createDataFrame([], "dim int, c1 int, c2 int, gap double")
    side = lambda k: blocks.select("dim", F.col("cell").alias(f"c{k}"), F.col("part").alias(f"p{k}"), F.col("radius").alias(f"r{k}"))
    pairs = pairs.join(side(1), ["dim", "c1"]).join(side(2), ["dim", "c2"]).where("c1 < c2 or p1 <= p2")
    pairs = pairs.where(F.col("gap") - F.col("r1") - F.col("r2") <= math.sqrt(2 - 2 * similarity) + F.lit(4e-7) + F.sqrt(F.col("dim")) * F.lit(1e-7)).withColumn("own", F.expr("c1 = c2 and p1 = p2"))
    key = ["dim", "c1", "p1", "c2", "p2"]
    one = pairs.select(*key, "own", F.lit(0).alias("side"), F.col("c1").alias("cell"), F.col("p1").alias("part"))
    two = pairs.where("not own").select(*key, "own", F.lit(1).alias("side"), F.col("c2").alias("cell"), F.col("p2").alias("part"))
    met = trees.drop("dist").join(one.unionByName(two), ["dim", "cell", "part"])
    found = written(by_group(met, key, ["side", "place"], _links(similarity), "rep long, links long, root long"), "links")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    spans = member.groupBy("vec_id").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).where("least <> most").select("vec_id", "least")
    ties = member.join(spans, "vec_id").select(F.col("least").alias("u"), F.col("rep").alias("v"))
    near = components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")).unionByName(ties))
    of = member.select("rep", "h", "weight").distinct().join(counts, "rep", "left").join(near.withColumnRenamed("node", "rep"), "rep", "left")
    of = of.select("h", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = v.withColumn("h", F.when(F.coalesce(sound, F.lit(False)), F.struct(F.xxhash64("vector").alias("a"), F.xxhash64(F.lit(3), "vector").alias("b")))).drop("vector").join(of, "h", "left")
    out = out.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.coalesce("n_links", F.lit(0))).alias("n_links"), F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").isNull() | F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


#: Every pair of vectors, and the components of the links.
ORACLE_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
 links AS (SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
    WHERE list_cosine_similarity(a.x, b.x) >= 0.9),
 reach(node, least) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT links.v, least FROM reach JOIN links ON node = u AND least < links.v)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE u = e.vec_id) AS n_links, r.least AS component_id, e.vec_id = r.least AS kept
FROM embeddings e JOIN (SELECT node, min(least) AS least FROM reach GROUP BY node) r ON e.vec_id = r.node
"""
