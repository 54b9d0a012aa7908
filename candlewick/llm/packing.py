"""Cost-balanced packing of documents into training sequences.

A piece of n tokens costs ``LINEAR * n + QUADRATIC * n * n``: the layers' work and the
attention within its document. A block of documents opens as many sequences as hold its
tokens exactly: whole ones, and for the rest one for each power of two in its size,
which the contract leaves unpadded. Documents over a sequence's length first fill whole
sequences. All others go, dearest first, each to the cheapest sequence that has room
for it; where none has, to the cheapest with any room, cut there. So no sequence is padded.

Blocks are of ``BLOCK`` tokens and stand within a partition of the scan: nothing is
shuffled, and a task holds one block. What a task yields depends on its input alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import parts, release
from .tokens import PART, encoder

SEQUENCE = 4096
BLOCK = 1 << 22
LINEAR, QUADRATIC = 1.0, 1.0 / 2048


def cost(n):
    return LINEAR * n + QUADRATIC * n * n


def pack(lengths: np.ndarray, size: int = SEQUENCE) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents of the given lengths."""
    total = int(lengths.sum())
    rest = total % size
    room = np.array([size] * (total // size) + [1 << k for k in range(size.bit_length() - 1, -1, -1) if rest >> k & 1], np.int64)
    filled, spent = np.zeros(len(room), np.int64), np.zeros(len(room))
    out = []

    def put(doc: int, start: int, n: int, s: int) -> None:
        out.append((doc, start, n, s, int(filled[s])))
        filled[s] += n
        room[s] -= n
        spent[s] = spent[s] + cost(n) if room[s] else np.inf

    begin = np.zeros(len(lengths), np.int64)
    s = 0
    for d in np.flatnonzero(lengths >= size).tolist():
        while lengths[d] - begin[d] >= size:
            put(d, int(begin[d]), size, s)
            begin[d] += size
            s += 1
    left = lengths - begin
    for d in np.argsort(-left, kind="stable").tolist():
        n = int(left[d])
        while n:
            fits = np.where(room >= n, spent, np.inf)
            s = int(fits.argmin())
            if fits[s] == np.inf:
                s = int(spent.argmin())
            now = min(n, int(room[s]))
            put(d, int(lengths[d]) - n, now, s)
            n -= now
    return out


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_length long"
_NAMES = [x.split()[0] for x in SCHEMA.split(", ")]


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, size: int = SEQUENCE) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_length.

    Each document's ids end with ``end_id``; a null or empty text is that id alone. Rows
    that repeat a doc_id are documents of their own; a null doc_id stays null. A
    sequence_id is the task's number times 2**32 plus a count within the task. An empty
    table gives no rows. Only doc_id and text are read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]):
        e = encoder(tokenizer)
        base = TaskContext.get().partitionId() << 32
        held: list[np.ndarray] = []
        names: list[int | None] = []
        n = 0

        def block():
            nonlocal base, held, names, n
            pieces = pack(np.array([len(x) for x in held], np.int64), size)
            doc, start, length, seq, offset = np.array(pieces, np.int64).T
            whole = np.bincount(seq, length).astype(np.int64)
            crc = [zlib.crc32(held[d][a : a + k].astype("<u4")) for d, a, k, _, _ in pieces]
            ids = pa.array(names, pa.int64()).take(pa.array(doc))
            tokens = np.array([len(x) for x in held], np.int64)[doc]
            out = [ids, start, length, np.array(crc, np.int64), tokens, seq + base, offset, whole[seq]]
            base += len(whole)
            held, names, n = [], [], 0
            return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in out], _NAMES)

        for b in batches:
            ids = b["doc_id"].to_pylist()
            texts = b["text"].to_pylist()
            for lo, hi in parts(texts, PART):
                for d, x in zip(ids[lo:hi], e.documents(texts[lo:hi], end_id), strict=True):
                    held.append(x.astype(e.dtype))
                    names.append(d)
                    n += len(x)
                    if n >= BLOCK:
                        yield block()
        if n:
            yield block()
        e.forget()  # a worker that waits between tasks keeps frequent chunks only
        release()

    return rows.mapInArrow(work, SCHEMA)
