"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

import contextlib
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Where it is unset, a session of one machine gets an own one."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="candlewick-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def new_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/candlewick/{what}-{uuid.uuid4().hex[:12]}"


#: What ``written`` wrote in this process and ``scratch`` has not removed.
_tables: list[str] = []


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Removes, at its end, the tables that were written within."""
    start = len(_tables)
    try:
        yield
    finally:
        for path in _tables[start:]:
            remove(spark, path)
        del _tables[start:]


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends there, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = new_path(spark, what)
    df.write.parquet(path)
    _tables.append(path)
    # shuffle files go once the driver collects its garbage; what was written needs none
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, df_or_path) -> None:
    """Deletes what ``written`` wrote, through Spark's file system layer."""
    paths = [df_or_path] if isinstance(df_or_path, str) else sorted({f.rsplit("/", 1)[0] for f in df_or_path.inputFiles()})
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        at = jvm.org.apache.hadoop.fs.Path(p)
        at.getFileSystem(conf).delete(at, True)


def runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of batches that are sorted by ``keys``; a group may span batches, and only one is held at a time."""
    held: list[pd.DataFrame] = []
    last = None
    for b in batches:
        if not len(b):
            continue
        cols = [b[k].to_numpy() for k in keys]
        new = np.zeros(len(b), dtype=bool)
        new[0] = True
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        cuts = [*np.flatnonzero(new), len(b)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            key = tuple(c[lo] for c in cols)
            if held and key != last:
                yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
                held = []
            last = key
            held.append(b.iloc[lo:hi])
    if held:
        yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)


def by_group(df: DataFrame, keys: list[str], order: list[str], f: Callable[[pd.DataFrame], pd.DataFrame | None], schema: str, at_least: int = 20_000) -> DataFrame:
    """``f`` on each group of ``keys``, the rows in ``order``; results go out in blocks rather than one small frame for each group."""
    names = [x.split()[0] for x in schema.split(",")]

    def work(batches):
        out, n = [], 0
        for g in runs(batches, keys):
            if (x := f(g)) is not None and len(x):
                out.append(x[names])
                n += len(x)
            if n >= at_least:
                yield pd.concat(out, ignore_index=True)
                out, n = [], 0
        if out:
            yield pd.concat(out, ignore_index=True)
        out = None
        release()

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(work, schema)


def parts(texts: list[str | None], chars: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Runs of texts of about so many characters; bounds what is in memory at a time, but for a single longer text."""
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi] or "") <= chars):
            size += len(texts[hi] or "")
            hi += 1
        yield lo, hi
        lo = hi


def release() -> None:
    """Gives memory that a Python worker has freed back to the system; workers stay between tasks and stages."""
    import ctypes

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


class Union:
    """Union-find over 0..n-1; the smaller root stays."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, a: int) -> int:
        up = self.up
        while up[a] != a:
            up[a] = up[up[a]]
            a = up[a]
        return a

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        if a < b:
            self.up[b] = a
        else:
            self.up[a] = b
        return True

    def roots(self) -> np.ndarray:
        """The root of every element."""
        up = np.array(self.up, np.int64)
        while not np.array_equal(top := up[up], up):
            up = top
        return up


def spanning(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links of a star forest with the same components as the links (u, v), each from a node to the smallest of its component."""
    ids, flat = np.unique(np.concatenate([u, v]), return_inverse=True)
    flat = flat.reshape(2, -1)
    forest = Union(len(ids))
    for a, b in zip(flat[0].tolist(), flat[1].tolist(), strict=True):
        forest.join(a, b)
    root = forest.roots()
    kept = root != np.arange(len(ids))
    return ids[kept], ids[root[kept]]


def components(edges: DataFrame, what: str = "components") -> DataFrame:
    """(node, component) for every node of the links (u, v); component is the smallest node reachable.

    Alternating large-star and small-star rounds: each round is an aggregate and a join
    over the links, so a component of any size and depth needs few rounds and no task
    holds one component. A node of very many links, of which there can be few, is looked up
    by broadcast, so its links stay spread. Partitions contract their own links first. Each round is
    written to the shared folder, which bounds lineage.
    """
    spark = edges.sparkSession

    def contract(batches):
        held_u, held_v, n = [], [], 0
        for b in batches:
            held_u.append(b["u"].to_numpy(np.int64))
            held_v.append(b["v"].to_numpy(np.int64))
            n += len(b)
            if n >= 1_000_000:
                u, v = spanning(np.concatenate(held_u), np.concatenate(held_v))
                held_u, held_v, n = [], [], 0
                yield pd.DataFrame({"u": u, "v": v})
        if n:
            u, v = spanning(np.concatenate(held_u), np.concatenate(held_v))
            yield pd.DataFrame({"u": u, "v": v})

    good = edges.where("u is not null and v is not null and u <> v").select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v"))
    now = written(good.mapInPandas(contract, "u long, v long"), what)
    mark = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    was = None
    while (is_now := mark(now)) != was:
        was = is_now
        if not is_now[0]:
            break
        # large star: every neighbour above u goes to the smallest neighbour of u
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        many = max(1000, is_now[0] // 1000)
        hubs, rest = F.broadcast(least.where(F.col("n") > many)), least.where(F.col("n") <= many)  # at most 2,000 hubs
        up = both.where("v > u")
        joined = up.join(hubs, "u").unionByName(up.join(hubs.select("u"), "u", "left_anti").join(rest, "u"))
        large = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: every smaller neighbour of u, and u, go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        after = written(small.distinct(), what)
        remove(spark, now)
        now = after
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).groupBy("node").agg(F.min("component").alias("component"))
