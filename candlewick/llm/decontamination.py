"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared as runs of letters and digits, lower-cased, one space between. A
test item of n characters may occur with up to ``ERRORS`` of n edits, k. Cut into k + 1
pieces, one piece at least must then occur unchanged. An Aho-Corasick automaton over all
pieces reads each whole document once. Pieces are leaves of a binary tree of ever longer
parts of their item: a part of 2**j pieces may hold at most its share of the errors, so a
hit climbs the tree and is dropped where no part around it matches so well (Navarro and
Baeza-Yates). What reaches the root is measured by Myers' bit-parallel algorithm; a match
is an occurrence within k edits.

An item of fewer than ``LEAST`` characters would occur by chance with edits; it is one piece,
which must stand there as it is, between blanks.

The benchmark, a fixed set of test items, is broadcast after its size is checked; a larger
one goes through in slices of ``SLICE`` characters. Each slice is a pass of its own, written
before the next, so a task holds one slice's automaton at a time.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import release, written

ERRORS = 0.1
#: Items of fewer characters are matched without edits, at word boundaries.
LEAST = 24
SLICE = 8_000_000
_NOT_WORD = re.compile(r"[\W_]+")


def plain(text: str | None) -> str:
    return _NOT_WORD.sub(" ", (text or "").lower()).strip()


def myers(pattern: str, text: str, most: int) -> tuple[int, int]:
    """(least edits, earliest end) of an occurrence of pattern within text; (most + 1, -1) if none is within most."""
    m = len(pattern)
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best, end = most + 1, -1
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph = ph << 1 & full  # an occurrence may begin anywhere
        mh = mh << 1 & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


class Item:
    """A test item: its pieces and, for each, the parts around it from the piece's parent up to the whole."""

    def __init__(self, text: str, exact: bool = False):
        self.text = f" {text} " if exact else text
        self.errors = 0 if exact else int(ERRORS * len(text))
        self.pieces: list[tuple[int, int, list[tuple[int, int, int]]]] = []
        self._cut(0, len(self.text), self.errors, [])

    def _cut(self, lo: int, hi: int, errors: int, above: list[tuple[int, int, int]]) -> None:
        """Of two halves with e errors together, one has at most e // 2 of them, or the other at most e - e // 2 - 1."""
        if errors <= 0 or hi - lo < 2:
            self.pieces.append((lo, hi, above))
            return
        left = errors // 2
        right = errors - left - 1
        mid = lo + (hi - lo) * (left + 1) // (errors + 1)
        part = [(lo, hi, errors), *above]
        self._cut(lo, mid, left, part)
        self._cut(mid, hi, right, part)


_held: list[tuple[str, Matcher]] = []


def matcher(key: str, items: Callable[[], list[tuple[int, str]]]) -> Matcher:
    """The automaton of a slice, kept by a process until it gets another."""
    if not _held or _held[0][0] != key:
        _held.clear()
        _held.append((key, Matcher(items())))
    return _held[0][1]


class Matcher:
    def __init__(self, items: list[tuple[int, str]], least: int = LEAST):
        import ahocorasick

        self.items = [(i, Item(t, len(t) < least)) for i, t in ((i, plain(t)) for i, t in items) if t]
        self.find = ahocorasick.Automaton()
        where: dict[str, list[tuple[int, int]]] = {}
        for n, (_, item) in enumerate(self.items):
            for p, (lo, hi, _) in enumerate(item.pieces):
                where.setdefault(item.text[lo:hi], []).append((n, p))
        for piece, at in where.items():
            self.find.add_word(piece, (len(piece), at))
        if where:
            self.find.make_automaton()
        self.empty = not where

    def matches(self, text: str | None) -> dict[int, int]:
        """Of each item that occurs in the text: its least number of edits."""
        if self.empty:
            return {}
        t = f" {plain(text)} "
        out: dict[int, int] = {}
        tried: set[tuple[int, int]] = set()
        failed: set[tuple[int, int, int, int]] = set()
        for end, (length, at) in self.find.iter(t):
            start = end + 1 - length
            for n, p in at:
                item_id, item = self.items[n]
                if out.get(item_id) == 0:
                    continue
                lo, _, above = item.pieces[p]
                origin = start - lo  # where the item would begin without edits before the piece
                if (n, origin) in tried:
                    continue
                for a, b, errors in above:
                    key = (n, a, b, origin)
                    if key in failed:
                        break
                    if a == 0 and b == len(item.text):
                        break  # measured below
                    x = max(0, origin + a - errors)
                    if myers(item.text[a:b], t[x : origin + b + errors], errors)[0] > errors:
                        failed.add(key)
                        break
                else:
                    a, b = 0, len(item.text)
                if (a, b) != (0, len(item.text)) or (n, a, b, origin) in failed:
                    continue
                tried.add((n, origin))
                k = item.errors
                edits, _ = myers(item.text, t[max(0, origin - k) : origin + len(item.text) + k], k)
                if edits <= k:
                    out[item_id] = min(edits, out.get(item_id, edits))
        return out


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, contaminated, item_ids (ascending), edits (the least, null without a match).

    A null or wordless text matches nothing, nor does an item that is null or wordless. Of rows
    that repeat an item_id, any may match. Rows that repeat a doc_id, or lack one, have
    a result each. Without items nothing is contaminated. Only doc_id, item_id and the
    texts are read.
    """
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    slices = max(1, -(-size // SLICE))
    out = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    for k in range(slices):
        part = items if slices == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == k)
        held = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in part.distinct().collect()])  # about SLICE characters

        def work(batches, held=held, key=uuid.uuid4().hex, keep=k < slices - 1, first=k == 0):
            m = matcher(key, lambda: held.value)
            for b in batches:
                found = [m.matches(x if isinstance(x, str) else None) for x in b["text"]]
                ids, edits = [sorted(f) for f in found], [min(f.values()) if f else None for f in found]
                if not first:
                    ids = [sorted({*x, *y}) for x, y in zip(ids, b["item_ids"], strict=True)]
                    edits = [min((int(z) for z in (x, y) if z is not None and z == z), default=None) for x, y in zip(edits, b["edits"], strict=True)]
                frame = pd.DataFrame({"doc_id": b["doc_id"], "item_ids": ids, "edits": pd.array(edits, dtype="Int32")})
                yield frame.assign(text=b["text"]) if keep else frame
            release()

        out = out.mapInPandas(work, "doc_id string, item_ids array<long>, edits int" + ", text string" * (k < slices - 1))
        if k < slices - 1:
            out = written(out, "matched")
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), (F.size("item_ids") > 0).alias("contaminated"), "item_ids", "edits")
