"""Near-duplicates of texts by an LSH forest over MinHash signatures, confirmed on full shingle sets.

1. Each text gets its shingle set, a fingerprint of the whole set and ``24 * depth``
   MinHashes. Texts of equal sets are one class; its smallest doc_id stands for it.
2. The forest: tree t orders the signature from entry ``t * depth`` on, cyclically. All
   documents are sorted in each tree's order, by ranges, so that a long run of equal
   prefixes is spread over tasks; one walk along the order finds where prefixes part.
   Neighbours that share the first ``depth`` entries form a region. ``depth`` is the largest
   at which a pair at the threshold shares no region in 24 trees with a chance of less than 1e-5.
3. The candidates. In a region of up to ``REGION`` documents, all of them. In a larger one, a
   crowd, the depth adapts: each document meets its longest-common-prefix neighbours, the
   ``REGION / 2`` before and after it at least, which connects most of the crowd cheaply.
   What is then still in different components meets too: each document outside the crowd's
   largest component meets all others, in pairs of blocks. So no task holds a crowd, and no pair is left out.
   Candidates whose signatures agree as a linked pair's could, five standard deviations
   aside, join a coarse class; only a spanning forest goes out.
4. Each coarse class gets its full shingle sets once. Candidates in different components are
   confirmed, the likeliest first, until none is undecided. A class too large for a task is
   cut into blocks: first neighbouring blocks meet; then, as in a crowd, what is outside the largest component.

Memory in a task: a range of an order, a region or a pair of blocks. Rows shuffled: in
proportion to documents; a crowd's or large class's once for each block of what is outside its largest
component. Only where no component is large do pairs grow as the square.
Steps 1 to 3 lose a linked pair with the chance above, or where its signatures agree by five
standard deviations too little (a chance of 3e-7); step 4 is exact on what they find.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import Union, by_group, components, parts, release, written
from .words import mix, overlap, shingles

TREES = 24
MISS = 1e-5
REGION = 512
CROWD_BLOCK = 4096
#: Classes of equal sets that are broadcast, at most.
LARGEST = 2000
BLOCK_DOCS, BLOCK_BYTES = 1024, 32 << 20


def depth_for(similarity: float) -> int:
    d = 1
    while (1 - similarity ** (d + 1)) ** TREES <= MISS and d < 8:
        d += 1
    return d


def multipliers(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)


def signatures(sets: list[np.ndarray], n: int) -> np.ndarray:
    """n MinHashes of 32 bits for each set that isn't empty."""
    by = multipliers(n)
    out = np.empty((len(sets), n), np.uint32)
    lo = 0
    while lo < len(sets):  # blocks that fit in a core's cache
        hi, size = lo, 0
        while hi < len(sets) and (hi == lo or size + len(sets[hi]) <= 16_384):
            size += len(sets[hi])
            hi += 1
        x = np.concatenate(sets[lo:hi])
        at = np.concatenate([[0], np.cumsum([len(s) for s in sets[lo : hi - 1]], dtype=np.int64)]).astype(np.int64)
        with np.errstate(over="ignore"):
            for k in range(n):
                out[lo:hi, k] = np.minimum.reduceat(x * by[k], at) >> np.uint64(32)
        lo = hi
    return out


def keys(sig: np.ndarray, depth: int) -> np.ndarray:
    """Of each document and tree a hash of the first ``depth`` entries in the tree's order."""
    n = sig.shape[1]
    at = (np.arange(TREES)[:, None] * depth + np.arange(depth)) % n
    x = np.broadcast_to(np.arange(1, TREES + 1, dtype=np.uint64), (len(sig), TREES)).copy()
    with np.errstate(over="ignore"):
        for j in range(depth):
            x = mix(x * np.uint64(0xE7037ED1A0B428DB) + sig[:, at[:, j]])
    return x.view(np.int64)


def prints(sets: list[np.ndarray]) -> np.ndarray:
    """Two 64-bit fingerprints (2, sets) of each whole set; 0 of an empty one."""
    count = np.array([len(s) for s in sets], np.int64)
    full = np.flatnonzero(count)
    out = np.zeros((2, len(sets)), np.int64)
    if len(full):
        at = np.concatenate([[0], np.cumsum(count[full])[:-1]])
        x = np.concatenate([sets[i] for i in full])
        with np.errstate(over="ignore"):
            out[0, full] = np.add.reduceat(mix(x + np.uint64(11)), at).view(np.int64)
            out[1, full] = np.bitwise_xor.reduceat(mix(x + np.uint64(17)), at).view(np.int64)
    return out


def sketch(docs: DataFrame, size: int, depth: int) -> DataFrame:
    """Of each row with a doc_id: shingle count, fingerprints of the set, signature (16 bits an entry; low bytes alone too), region keys of each tree."""
    n = TREES * depth

    def work(batches):
        for b in batches:
            texts = [x if isinstance(x, str) else None for x in b["text"]]
            for lo, hi in parts(texts):
                p = b.iloc[lo:hi]
                sets = shingles(texts[lo:hi], size)
                full = [i for i, s in enumerate(sets) if len(s)]
                fps = prints(sets)
                sig, low, ks = [b""] * len(p), [b""] * len(p), [[]] * len(p)
                if full:
                    m = signatures([sets[i] for i in full], n)
                    short = (m & 0xFFFF).astype("<u2")
                    last = (m & 0xFF).astype(np.uint8)
                    for j, (i, k) in enumerate(zip(full, keys(m, depth), strict=True)):
                        sig[i], low[i], ks[i] = short[j].tobytes(), last[j].tobytes(), k
                yield pd.DataFrame({"doc_id": p["doc_id"].to_numpy(np.int64), "n": [len(s) for s in sets], "fp1": fps[0], "fp2": fps[1], "sig": sig, "low": low, "regions": ks})
        release()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null")
    return rows.mapInPandas(work, "doc_id long, n long, fp1 long, fp2 long, sig binary, low binary, regions array<long>")


def without_id(docs: DataFrame, size: int) -> DataFrame:
    """Result rows of the rows that lack a doc_id."""

    def work(batches):
        for b in batches:
            texts = [x if isinstance(x, str) else None for x in b["text"]]
            for lo, hi in parts(texts):
                yield pd.DataFrame({"n_shingles": [len(s) for s in shingles(texts[lo:hi], size)]})

    n = docs.where("doc_id is null").select(F.col("text").cast("string").alias("text")).mapInPandas(work, "n_shingles long")
    return n.select(F.lit(None).cast("long").alias("doc_id"), "n_shingles", F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept"))


def agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal entries for each pair of rows of a and b."""
    out = np.empty((len(a), len(b)), np.float32)
    step = max(1, 262_144 // len(b))
    columns = np.ascontiguousarray(b.T)
    for lo in range(0, len(a), step):
        rows = np.ascontiguousarray(a[lo : lo + step].T)
        equal = np.zeros((rows.shape[1], len(b)), np.uint8 if len(columns) < 256 else np.uint16)
        for x, y in zip(rows, columns, strict=True):
            equal += x[:, None] == y[None]
        out[lo : lo + step] = equal.astype(np.float32) / np.float32(len(columns))
    return out


def crossing(sig: np.ndarray, own: Union, left: np.ndarray, right: np.ndarray, cut: float, step: int = REGION) -> list[tuple[int, int]]:
    """Joins in ``own`` the rows of ``left`` and ``right`` that agree by ``cut``; gives the links. What is connected is not compared."""
    found = []
    for i in range(0, len(left), step):
        for j in range(0, len(right), step):
            a, b = left[i : i + step], right[j : j + step]
            roots = own.roots()
            ra, rb = roots[a], roots[b]
            # a row whose component is all of the other side has nothing to find there
            if (rb == rb[0]).all():
                a, ra = a[ra != rb[0]], ra[ra != rb[0]]
            if len(a) and (ra == ra[0]).all():
                b, rb = b[rb != ra[0]], rb[rb != ra[0]]
            if len(a) and len(b):
                x, y = np.nonzero((agreement(sig[a], sig[b]) >= cut) & (ra[:, None] != rb[None]))
                found += [(p, q) for p, q in zip(a[x].tolist(), b[y].tolist(), strict=True) if own.join(p, q)]
    return found


def walk(batches):
    """Along a range of the trees' orders: the rows of each region, with their place in it and the groups in which they meet.

    A region of up to REGION rows is one group; in a larger one the groups are windows of
    REGION rows, and as many half a window further. A region at the range's edge may go on beyond.
    """
    own = np.uint64(TaskContext.get().partitionId() + 1)

    def out(held: list[pd.DataFrame], begins: bool, ends: bool) -> pd.DataFrame:
        g = held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
        key = g["region"].to_numpy()
        start = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1])
        size = np.diff(np.append(start, len(key)))
        edge = np.zeros(len(start), bool)
        edge[0] |= begins
        edge[-1] |= ends
        keep = np.repeat((size > 1) | edge, size)
        place = (np.arange(len(key)) - np.repeat(start, size))[keep]
        size, edge, key = np.repeat(size, size)[keep], np.repeat(edge, size)[keep], key[keep]
        crowd = size > REGION
        with np.errstate(over="ignore"):
            window = lambda shift: mix(mix(key.view(np.uint64) + own) + ((place + shift) // REGION * 2 + (shift > 0)).astype(np.uint64)).view(np.int64)
            meet, again = np.where(crowd, window(0), key), window(REGION // 2)
        return pd.DataFrame({"region": key, "doc_id": g["doc_id"].to_numpy()[keep], "task": int(own), "place": place, "edge": edge, "crowd": crowd, "meet": meet, "again": pd.Series(again, dtype="Int64").where(crowd)})

    held: list[pd.DataFrame] = []
    begins = True
    for b in batches:
        if not len(b):
            continue
        key = b["region"].to_numpy()
        change = np.flatnonzero(np.diff(key))
        if held and held[-1]["region"].iloc[-1] == key[0] and not len(change):
            held.append(b)
            continue
        last = int(change[-1]) + 1 if len(change) else 0
        if held or last:
            yield out([*held, b.iloc[:last]], begins, False)
            begins = False
        held = [b.iloc[last:]]
    if held:
        yield out(held, begins, True)
    release()


def outsiders(rows: DataFrame, group: str, size: int) -> DataFrame:
    """Who must still meet in each group of rows (group, component, block, blocks and others) with several components.

    Rows outside the group's largest component are dealt into blocks, ``ob``; each meets
    every block of the group, ``mb``. Adds ob, mb and ``side``: 0 for those outside, 1 for all.
    """
    n = rows.groupBy(group, "component").agg(F.count("*").alias("n"))
    most = n.groupBy(group).agg(F.max_by("component", F.struct("n", "component")).alias("main"), (F.sum("n") - F.max("n")).alias("out"))
    rows = rows.join(most.where("out > 0").withColumn("obs", F.ceil(F.col("out") / size).cast("int")).drop("out"), group)
    span = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    own = F.pmod(F.xxhash64(*[c for c in rows.columns if c in ("doc_id", "node")]), F.col("obs")).cast("int")
    out = rows.where("component <> main").withColumn("ob", own).withColumn("mb", span("blocks")).withColumn("side", F.lit(0))
    return out.unionByName(rows.withColumn("ob", span("obs")).withColumn("mb", F.col("block")).withColumn("side", F.lit(1))).drop("main", "obs", "blocks", "block")


def known(component: pd.Series) -> Union:
    """Rows of equal components joined."""
    own = Union(len(component))
    first: dict[int, int] = {}
    for i, c in enumerate(component.tolist()):
        own.join(first.setdefault(c, i), i)
    return own


def forest(reps: DataFrame, cut: float, depth: int) -> DataFrame:
    """Coarse links (u, v) between class representatives (doc_id, sig, low, regions)."""
    n = TREES * depth
    tree = reps.select("doc_id", F.concat("low", "low").alias("low"), F.posexplode("regions").alias("tree", "region"))
    # within a region by the entries after the first depth; by region and these a tree's order is total but for equal signatures
    further = F.substring("low", (F.col("tree") + 1) * depth % n + 1, F.lit(min(3 * depth, n)))
    order = tree.select("region", further.alias("further"), "doc_id").repartitionByRange("region", "further", "doc_id").sortWithinPartitions("region", "further", "doc_id")
    walked = written(order.select("region", "doc_id").mapInPandas(walk, "region long, doc_id long, task int, place long, edge boolean, crowd boolean, meet long, again long"), "walked")
    # regions that go over a range's edge, two a task at most
    split = walked.where("edge").groupBy("region").agg(F.count("*").alias("n")).where(F.col("n") > REGION).select("region", F.lit(True).alias("split"))
    walked = walked.join(F.broadcast(split), "region", "left").withColumn("large", F.coalesce("split", F.lit(False)) | F.col("crowd"))
    group = F.when(F.col("crowd"), F.array("meet", "again")).when(F.col("large"), F.array(F.xxhash64("region", "task"))).otherwise(F.array("region"))
    rows = walked.select("doc_id", F.explode(group).alias("region")).join(reps.select("doc_id", "sig"), "doc_id")

    def links(g: pd.DataFrame) -> pd.DataFrame | None:
        if len(g) < 2:
            return None
        ids = g["doc_id"].to_numpy()
        sig = np.frombuffer(b"".join(g["sig"]), "<u2").reshape(len(g), -1)
        found = [], []
        own = Union(len(g))
        a, b = np.nonzero(np.triu(agreement(sig, sig) >= cut, 1))
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            if own.join(i, j):
                found[0].append(ids[i])
                found[1].append(ids[j])
        return pd.DataFrame({"u": np.minimum(*map(np.array, found)), "v": np.maximum(*map(np.array, found))}) if found[0] else None

    near = by_group(rows, ["region"], ["sig"], links, "u long, v long").distinct()
    crowds = walked.where("large")
    if crowds.isEmpty():
        return near
    near = written(near, "links")
    own = components(near, "crowded").withColumnRenamed("node", "doc_id")
    # a row's place in the whole region, from the sizes of its parts: a row for each task
    sizes = crowds.groupBy("region", "task").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("region")
    sizes = sizes.select("region", "task", (F.sum("n").over(whole.orderBy("task")) - F.col("n")).alias("before"), F.sum("n").over(whole).alias("total"))
    crowds = crowds.join(sizes, ["region", "task"]).join(own, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    crowds = written(crowds.select("region", "doc_id", "component", F.floor((F.col("before") + F.col("place")) / CROWD_BLOCK).cast("int").alias("block"), F.ceil(F.col("total") / CROWD_BLOCK).cast("int").alias("blocks")), "crowds")
    crowds = outsiders(crowds, "region", CROWD_BLOCK)

    def across(g: pd.DataFrame) -> pd.DataFrame | None:
        ids, side = g["doc_id"].to_numpy(), g["side"].to_numpy()
        sig = np.frombuffer(b"".join(g["sig"]), "<u2").reshape(len(g), -1)
        found = crossing(sig, known(g["component"]), np.flatnonzero(side == 0), np.flatnonzero(side == 1), cut)
        return pd.DataFrame(np.sort(ids[np.array(found)], 1), columns=["u", "v"]) if found else None

    more = by_group(crowds.join(reps.select("doc_id", "sig"), "doc_id"), ["region", "ob", "mb"], ["sig"], across, "u long, v long")
    return near.unionByName(more).distinct()


def confirm(docs: DataFrame, coarse: DataFrame, reps: DataFrame, size: int, percent: int, cut: float) -> DataFrame:
    """Confirmed links (u, v) that span the components within each coarse class (node, component)."""
    members = coarse.join(reps.select(F.col("doc_id").alias("node"), "sig", "n", "fp1"), "node")
    sizes = members.groupBy("component").agg(F.greatest(F.ceil(F.count("*") / BLOCK_DOCS), F.ceil(F.sum("n") * 8 / BLOCK_BYTES)).cast("int").alias("blocks"))
    members = members.join(sizes, "component")
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").alias("text")).join(members, "node")

    def sets(batches):
        for b in batches:
            texts = list(b["text"])
            for lo, hi in parts(texts):
                own = shingles(texts[lo:hi], size)
                p = b.iloc[lo:hi].assign(shingles=[s.tobytes() for s in own]).drop(columns=["text"])
                # of a doc_id with several texts, each signature goes with its own
                yield p[p["fp1"].to_numpy() == prints(own)[0]]
        release()

    full = texts.mapInPandas(sets, "node long, component long, sig binary, n long, fp1 long, blocks int, shingles binary").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    full = full.drop("n")
    bands = max(1, math.ceil(TREES * depth_for(percent / 100) * (1 - cut)))

    def meeting(g: pd.DataFrame, left: np.ndarray, right: np.ndarray, own: Union) -> pd.DataFrame | None:
        """Confirmed links between rows of left and right (the same array: each pair once), until all that link are connected."""
        if len(g) < 2:
            return None
        ids = g["node"].to_numpy()
        sig = np.frombuffer(b"".join(g["sig"]), "<u2").reshape(len(g), -1)
        sets = [np.frombuffer(x, np.uint64) for x in g["shingles"]]
        lens = np.array([len(s) for s in sets])
        found = []
        # some documents against all at a time; of their pairs the likeliest first, and what is connected by then needs no look
        for lo in range(0, len(left), 256):
            i, root = left[lo : lo + 256], own.roots()
            s = agreement(sig[i], sig[right])
            few, many = np.minimum(lens[i, None], lens[None, right]), np.maximum(lens[i, None], lens[None, right])
            a, b = np.nonzero((s >= cut) & (100 * few >= percent * many) & (root[i, None] != root[None, right]))
            if left is right:
                once = a + lo < b
                a, b = a[once], b[once]
            band = np.minimum(((1 - s[a, b]) * sig.shape[1] + 0.5).astype(int), bands)
            a, b = i[a], right[b]
            for k in np.unique(band):
                root = own.roots()
                rest = (band == k) & (root[a] != root[b])
                for x, y in zip(a[rest].tolist(), b[rest].tolist(), strict=True):
                    if own.find(x) != own.find(y):
                        both = overlap(sets[x], sets[y])
                        if 100 * both >= percent * (int(lens[x]) + int(lens[y]) - both):
                            own.join(x, y)
                            found.append((ids[x], ids[y]))
        return pd.DataFrame(found, columns=["u", "v"]) if found else None

    def whole(g: pd.DataFrame) -> pd.DataFrame | None:
        every = np.arange(len(g))
        return meeting(g, every, every, Union(len(g)))

    def bipartite(g: pd.DataFrame) -> pd.DataFrame | None:
        side = g["side"].to_numpy()
        return meeting(g, np.flatnonzero(side == 0), np.flatnonzero(side == 1), known(g["component"]))

    out = "u long, v long"
    large = written(members.where("blocks > 1").select("component").distinct(), "large")
    if large.isEmpty():
        return by_group(full.where("blocks = 1").dropDuplicates(["component", "node", "fp1"]), ["component"], ["node"], whole, out)
    full = written(full.dropDuplicates(["component", "node", "fp1"]), "shingles")
    small = by_group(full.where("blocks = 1"), ["component"], ["node"], whole, out)
    giant = full.where("blocks > 1").withColumnRenamed("component", "class")
    # a block with the one before it
    near = written(by_group(giant.withColumn("group", F.explode(F.array(F.col("block"), F.col("block") + 1))), ["class", "group"], ["node"], whole, out), "links")
    own = components(near, "confirmed")
    rest = giant.select("class", "node", "fp1", "block", "blocks").join(own, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rest = outsiders(rest, "class", BLOCK_DOCS).join(giant.select("class", "node", "fp1", "sig", "shingles"), ["class", "node", "fp1"])
    return small.unionByName(near).unionByName(by_group(rest, ["class", "ob", "mb"], ["node"], bipartite, out))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept (whether it stands for its component).

    Texts link if ``100 * intersection >= percent * union`` of their sets of ``size``-word
    shingles. A null or wordless text has an empty set and links with nothing. Rows that
    repeat a doc_id are one node, which has the links of all its texts and, in each row,
    that row's n_shingles. A row without doc_id links with nothing: component_id is null and it is kept. An empty
    table gives an empty one. Only doc_id and text are read, whatever other columns there are.
    """
    depth = depth_for(percent / 100)
    entries = TREES * depth
    p = percent / 100
    cut = p - 5 * math.sqrt(p * (1 - p) / entries)
    base = written(sketch(docs, size, depth), "sketch")
    key = ["fp1", "fp2", "n"]
    nonempty = base.where("n > 0")
    classes = written(nonempty.groupBy(*key).agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "sets")
    # the most copied classes, of which there are LARGEST at most, are looked up by broadcast, so that their copies needn't meet in a task
    least = max(REGION, math.ceil(base.count() / LARGEST))

    def classed(rows: DataFrame, of: DataFrame) -> DataFrame:
        """rows with the columns of their class in ``of`` (key, copies and others)."""
        hot = of.where(F.col("copies") > least).drop("copies")
        rest = rows.join(F.broadcast(hot.select(*key)), key, "left_anti")
        return rows.join(F.broadcast(hot), key).unionByName(rest.join(of.where(F.col("copies") <= least).drop("copies"), key))

    firsts = classes.withColumnRenamed("rep", "doc_id").drop("copies")
    reps = written(nonempty.join(firsts, ["doc_id", *key]).dropDuplicates(["doc_id", "fp1", "fp2"]).drop("fp2"), "reps")
    coarse = written(components(forest(reps, cut, depth), "coarse"), "classes")
    near = confirm(docs, coarse, reps, size, percent, cut)
    # a repeated doc_id with several texts ties their classes together
    several = written(base.select("doc_id", *key).distinct().groupBy("doc_id").count().where("count > 1").select("doc_id"), "several")
    if not several.isEmpty():
        member = classed(nonempty.select("doc_id", *key).join(several, "doc_id").distinct(), classes)
        least_rep = member.groupBy("doc_id").agg(F.min("rep").alias("u"))
        near = near.unionByName(member.join(least_rep, "doc_id").select("u", F.col("rep").alias("v")))
    found = components(near, "near")
    named = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(*key, "copies", F.coalesce("component", "rep").alias("component_id"))
    ids = base.select("doc_id", *key)
    out = classed(ids.where("n > 0"), named).unionByName(ids.where("n = 0").withColumn("component_id", F.col("doc_id")))
    if not several.isEmpty():
        # every row of such a doc_id has the component of its texts with words
        own = out.where("n > 0").join(several, "doc_id").groupBy("doc_id").agg(F.min("component_id").alias("own"))
        out = out.join(own, "doc_id", "left").withColumn("component_id", F.coalesce("own", "component_id"))
    out = out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))
    return out.unionByName(without_id(docs, size))


#: Every pair of documents with a common 3-word shingle, and the components of the links.
ORACLE_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
 s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')) END) AS g FROM w),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
 c AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
 links AS (SELECT u, v FROM c JOIN n x ON c.u = x.doc_id JOIN n y ON c.v = y.doc_id WHERE 100 * k >= 85 * (x.n + y.n - k)),
 reach(node, least) AS (SELECT doc_id, doc_id FROM documents UNION SELECT links.v, least FROM reach JOIN links ON node = u AND least < links.v)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.least AS component_id, d.doc_id = r.least AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT node, min(least) AS least FROM reach GROUP BY node) r ON d.doc_id = r.node
"""
