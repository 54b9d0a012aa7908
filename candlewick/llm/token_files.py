"""Token-id files: documents compressed one by one with a shared zstandard dictionary.

A shard is one file: magic, a JSON header with the id width and the dictionary's SHA-256,
a zstandard frame for each document, then the index (doc_id, whether it is null, token
count, frame offset) and its place. A document is read with one seek. The dictionary is
a file beside the shards, trained on the serialized ids of at most ``SAMPLE`` documents of
``SAMPLE_CHARS`` characters, those with the least hashes; a reader checks its hash before use.

Documents are dealt by range of doc_id and sorted, so shard after shard holds ascending
doc_ids. A shard is written under another name and then renamed; a task that runs
again writes the same bytes, so a lost executor does no harm. Files go through
``pyarrow.fs``: local, HDFS and object stores alike.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import new_path, parts, release, written
from .tokens import PART, encoder

MAGIC = b"CWTOK01\n"
#: The dictionary is trained on the documents with the least hashes: at most so many, of so many characters together.
SAMPLE = 1024
SAMPLE_CHARS = 8 << 20
DICTIONARY_BYTES = 64 << 10
SHARD = "shard-%08d.tok"


def _fs(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)


def put(uri: str, data: bytes) -> None:
    fs, path = _fs(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    tmp = f"{path}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(tmp) as f:
        f.write(data)
    fs.move(tmp, path)


def get(uri: str) -> bytes:
    fs, path = _fs(uri)
    with fs.open_input_file(path) as f:
        return f.read()


def train_dictionary(samples: list[bytes]) -> bytes:
    """Empty where there is too little to train on; frames then need none."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if len(samples) >= 16 else b""
    except zstandard.ZstdError:
        return b""


class ShardWriter:
    """Frames go out a megabyte at a time; only the index is held until ``close``."""

    def __init__(self, uri: str, dictionary: bytes, dtype: np.dtype):
        import zstandard

        self.fs, self.path = _fs(uri)
        self.tmp = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.out = self.fs.open_output_stream(self.tmp)
        self.zip = zstandard.ZstdCompressor(level=1, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None, write_checksum=True)
        self.dtype = dtype
        head = json.dumps({"width": dtype.itemsize, "dictionary": hashlib.sha256(dictionary).hexdigest()}).encode()
        self.out.write(MAGIC + struct.pack("<I", len(head)) + head)
        self.at = len(MAGIC) + 4 + len(head)
        self.rows: list[tuple[int, bool, int, int]] = []
        self.held: list[bytes] = []
        self.waiting = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        frame = self.zip.compress(ids.astype(self.dtype).tobytes())
        self.held.append(frame)
        self.waiting += len(frame)
        if self.waiting >= 1 << 20:
            self._flush()
        self.rows.append((doc_id or 0, doc_id is None, len(ids), self.at))
        self.at += len(frame)

    def _flush(self) -> None:
        self.out.write(b"".join(self.held))
        self.held, self.waiting = [], 0

    def close(self) -> tuple[int, int]:
        self._flush()
        table = np.array(self.rows, np.int64).reshape(-1, 4)
        body = np.concatenate([table.T.ravel(), [self.at]]).astype("<i8").tobytes()
        self.out.write(body + struct.pack("<QQ", len(self.rows), self.at) + MAGIC)
        self.out.close()
        self.fs.move(self.tmp, self.path)
        return len(self.rows), int(table[:, 2].sum())


class ShardReader:
    def __init__(self, uri: str, dictionary: bytes):
        import zstandard

        fs, path = _fs(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        tail = self.file.read_at(24, size - 24)
        head = self.file.read_at(len(MAGIC) + 4, 0)
        if tail[16:] != MAGIC or head[: len(MAGIC)] != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        info = json.loads(self.file.read_at(struct.unpack("<I", head[-4:])[0], len(MAGIC) + 4))
        if info["dictionary"] != hashlib.sha256(dictionary).hexdigest():
            raise ValueError(f"{uri} was written with another dictionary")
        n, at = struct.unpack("<QQ", tail[:16])
        index = np.frombuffer(self.file.read_at(8 * (4 * n + 1), at), "<i8")
        self.doc_ids, self.null, self.tokens, begin = index[:-1].reshape(4, n)
        self.offsets = np.append(begin, index[-1])
        self.dtype = np.dtype(f"<u{info['width']}")
        self.unzip = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)

    def __len__(self) -> int:
        return len(self.tokens)

    def ids(self, i: int) -> np.ndarray:
        """The ids of the shard's i-th document."""
        frame = self.file.read_at(int(self.offsets[i + 1] - self.offsets[i]), int(self.offsets[i]))
        return np.frombuffer(self.unzip.decompress(frame), self.dtype).astype("<u4")

    def find(self, doc_id: int) -> np.ndarray | None:
        """The ids of the first document of that doc_id; doc_ids ascend."""
        known = np.flatnonzero(self.null == 0)
        i = np.searchsorted(self.doc_ids[known], doc_id)
        return self.ids(int(known[i])) if i < len(known) and self.doc_ids[known[i]] == doc_id else None

    def all(self) -> Iterator[np.ndarray]:
        """Of all documents in order, read some megabytes at a time."""
        at, lo = self.offsets, 0
        while lo < len(self):
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + (4 << 20), "right")) - 1)
            block = memoryview(self.file.read_at(int(at[hi] - at[lo]), int(at[lo])))
            for i in range(lo, hi):
                yield np.frombuffer(self.unzip.decompress(block[at[i] - at[lo] : at[i + 1] - at[lo]]), self.dtype).astype("<u4")
            lo = hi


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, path: str | None = None) -> tuple[str, DataFrame]:
    """Writes the ids of every whole text of ``docs`` and returns the folder and its shards (shard, documents, tokens, start).

    A null text is empty: the end id alone. Null doc_ids come first, equal ones in the
    order of their texts' hashes. An empty table makes no shard. Only doc_id and text
    are read.
    """
    spark = docs.sparkSession
    path = path or new_path(spark, "tokens")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def sample(batches: Iterator[pa.RecordBatch]):
        e = encoder(tokenizer)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["h"], pa.array([x.astype(e.dtype).tobytes() for x in e.documents(b["text"].to_pylist(), end_id)], pa.binary())], ["h", "ids"])

    # keys and lengths first; then the texts of those that are within the bounds
    h = F.xxhash64("doc_id", "text")
    keys = rows.select(h.alias("h"), F.coalesce(F.length("text"), F.lit(0)).alias("n")).orderBy("h", "n").limit(SAMPLE).collect()
    chars = np.cumsum([r.n for r in keys])
    few = [r.h for r, c in zip(keys, chars.tolist(), strict=True) if c <= SAMPLE_CHARS]
    found = rows.where(h <= few[-1]).select(h.alias("h"), "text").dropDuplicates(["h"]).repartition(8, "h").mapInArrow(sample, "h long, ids binary").orderBy("h").limit(SAMPLE).collect() if few else []
    dictionary = train_dictionary([bytes(r.ids) for r in found])
    del found
    put(f"{path}/dictionary", dictionary)

    def write(batches: Iterator[pa.RecordBatch]):
        e = encoder(tokenizer)
        shard, out = TaskContext.get().partitionId(), None
        for b in batches:
            ids = b["doc_id"].to_pylist()
            texts = b["text"].to_pylist()
            for lo, hi in parts(texts, PART):
                if out is None:
                    out = ShardWriter(f"{path}/{SHARD % shard}", dictionary, e.dtype)
                for d, x in zip(ids[lo:hi], e.documents(texts[lo:hi], end_id), strict=True):
                    out.add(d, x)
        if out is not None:
            n, tokens = out.close()
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (shard, n, tokens)], ["shard", "documents", "tokens"])
        release()

    # by hash too, so that texts of one doc_id, or of none, spread over tasks
    dealt = rows.withColumn("h", F.xxhash64("text")).repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").drop("h")
    shards = written(dealt.mapInArrow(write, "shard long, documents long, tokens long"), "shards")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    return path, shards.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_tokens(spark: SparkSession, path: str, shards: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""

    def read(batches: Iterator[pa.RecordBatch]):
        dictionary = None
        for b in batches:
            for shard, start in zip(b["shard"].to_pylist(), b["start"].to_pylist(), strict=True):
                dictionary = get(f"{path}/dictionary") if dictionary is None else dictionary
                r = ShardReader(f"{path}/{SHARD % shard}", dictionary)
                crc, n = [], []
                for ids in r.all():
                    crc.append(zlib.crc32(ids))
                    n.append(len(ids))
                n = np.array(n, np.int64)
                starts = start + np.cumsum(n) - n
                yield pa.RecordBatch.from_arrays([pa.array(r.doc_ids, pa.int64(), mask=r.null.astype(bool)), pa.array(starts), pa.array(n), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    # a number of partitions that is given stays, however few bytes the names of files are
    each = shards.select("shard", "start").repartitionByRange(max(1, shards.count()), "shard")
    return each.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
