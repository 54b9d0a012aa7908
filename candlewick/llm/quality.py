"""Document quality by weak labels: no hand label is used.

Heuristic labellers each vote good, bad or nothing on a text. Votes overlap and err, so
expectation-maximisation estimates each labeller's accuracy and the share of good texts
from how often each pattern of votes occurs, over all documents; there are at most
3 ** 8 patterns, whatever the corpus. A pattern's posterior then labels a bounded sample
of texts (``SAMPLE``, those with the least hashes of text and doc_id), on which a linear scorer over hashed
features is trained: words, their shapes, and the steps of a few measures. The scorer,
not the votes, judges each document, in one scan without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import parts, release
from .words import join_bytes, mix, segment_hashes, word_spans

SAMPLE = 6000
WIDTH = 1 << 16
PASSES = 12
#: The most good texts on which a labeller may vote bad.
FALSE_ALARM = 0.01
#: The least share of bad texts that are of a labeller's kind.
SHARE = 0.1

_LOWER, _UPPER, _DIGIT, _ODD = (np.zeros(256, bool) for _ in range(4))
_LOWER[97:123] = _UPPER[65:91] = _DIGIT[48:58] = True
_ODD[[ord(c) for c in "#$%&*<>@[]\\^_`{|}~=+!"]] = True
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".,;:?!\"')"]] = True

#: Measure, bad from, good below (reversed where bad is below), as shares of words unless said.
LABELLERS = (
    ("odd", 0.15, 0.05, False),  # words that hold an odd sign
    ("loud", 0.30, 0.12, False),  # words of two capitals or more
    ("same", 0.12, 0.05, False),  # words equal to the one before
    ("distinct", 0.30, 0.50, True),  # distinct words, of at least 40 words
    ("ended", 0.02, 0.04, True),  # words with punctuation after them, of at least 40
    ("table", 0.08, 0.02, False),  # words that are a lone sign
    ("repeats", 0.35, 0.15, False),  # pairs of words that came before
    ("digits", 0.40, 0.15, False),  # words with a digit
)


class Measures:
    """Per text: the labellers' measures and the hashed features of the scorer."""

    def __init__(self, texts: list[str | None]):
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        buf, at = join_bytes(raw)
        starts, ends = word_spans(buf)
        self.n = n = np.diff(np.searchsorted(starts, at))
        doc = np.repeat(np.arange(len(texts)), n)
        low = np.where(_UPPER[buf], buf + 32, buf).astype(np.uint8)
        self.words = segment_hashes(low, starts, ends)
        self.doc = doc
        count = lambda mask: np.concatenate([[0], np.cumsum(mask[buf], dtype=np.int32)])
        span = lambda c: c[ends] - c[starts]
        size = ends - starts
        odd, upper, digit = span(count(_ODD)), span(count(_UPPER)), span(count(_DIGIT))
        lower = span(count(_LOWER))
        last = _END[buf[ends - 1]] if len(ends) else np.zeros(0, bool)
        share = lambda x: np.bincount(doc, x, len(texts)) / np.maximum(n, 1)
        before = np.zeros(len(doc), bool)
        before[1:] = (self.words[1:] == self.words[:-1]) & (doc[1:] == doc[:-1])
        pair = np.zeros(len(doc), np.uint64)
        with np.errstate(over="ignore"):
            pair[1:] = mix(self.words[1:] * np.uint64(0x9E3779B97F4A7C15) + self.words[:-1])
            seen = lambda h: _again(mix(h + mix(doc.astype(np.uint64))))
            again, twice = seen(self.words), seen(pair)
        twice[np.flatnonzero(np.diff(doc, prepend=-1))] = False
        lone = (size == 1) & (odd == 1)
        many = n >= 40
        self.values = np.stack([share(odd > 0), share((upper > 1) & (upper >= size // 2)), share(before), np.where(many, 1 - share(again), np.nan), np.where(many, share(last), np.nan), share(lone), np.where(many, share(twice), np.nan), share(digit > 0)], 1)
        # a word's shape: which kinds of sign it holds, whether punctuation ends it, its length up to 15
        shape = (odd > 0) * 1 + (upper > 1) * 2 + (upper == 1) * 4 + (digit > 0) * 8 + (lower > 0) * 16 + last * 32 + before * 64 + twice * 128
        self.shape = shape.astype(np.uint64) * np.uint64(16) + np.minimum(size, 15).astype(np.uint64)

    def votes(self) -> np.ndarray:
        """(texts, labellers): 1 good, -1 bad, 0 no vote. A text without words gets none."""
        out = np.zeros(self.values.shape, np.int8)
        for k, (_, bad, good, below) in enumerate(LABELLERS):
            v = self.values[:, k]
            with np.errstate(invalid="ignore"):
                out[:, k] = np.where(v <= bad, -1, np.where(v >= good, 1, 0)) if below else np.where(v >= bad, -1, np.where(v < good, 1, 0))
        out[self.n == 0] = 0
        out[np.isnan(self.values)] = 0
        return out

    def features(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, column, value): each text's words and shapes at length one together, and a 1 for each measure's step."""
        with np.errstate(over="ignore"):
            column = np.concatenate([self.words % np.uint64(WIDTH), mix(self.shape + np.uint64(0x51ED27)) % np.uint64(WIDTH)]).astype(np.int64)
        doc = np.concatenate([self.doc, self.doc])
        value = 1 / np.maximum(self.n, 1)[doc]
        steps = np.nan_to_num(np.ceil(np.sqrt(self.values) * 12), nan=31).astype(np.uint64) + (np.arange(self.values.shape[1], dtype=np.uint64) * np.uint64(64))
        where = (mix(steps + np.uint64(0xABCDEF)) % np.uint64(WIDTH)).astype(np.int64)
        rows = np.repeat(np.arange(len(self.n)), self.values.shape[1])
        return np.concatenate([doc, rows]).astype(np.int32), np.concatenate([column, where.ravel()]).astype(np.int32), np.concatenate([value, np.full(len(rows), 0.3)]).astype(np.float32)


def _again(h: np.ndarray) -> np.ndarray:
    """Whether an equal entry came before."""
    out = np.ones(len(h), bool)
    out[np.unique(h, return_index=True)[1]] = False
    return out


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 300) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior of good for each pattern of votes, each labeller's rates, and the share of good texts.

    rates[c, k] is how often labeller k, when it votes on a text of class c (0 good, 1 bad),
    votes bad. No vote is no evidence. A labeller looks for one kind of bad text and may
    pass over all others, so its good votes on bad texts have no bound. Kinds of bad text
    exclude each other, and the likeliest two classes could be one kind and all the
    rest, or one class of all. Thresholds are set so that few good texts get a bad vote, and
    labellers so that each sees a fair share of bad ones; bounds on the rates say so.
    Labellers are taken to vote independently given the class; priors keep rates off 0 and 1.
    """
    votes = np.stack([patterns == -1, patterns == 1], 2).astype(np.float64)  # pattern, labeller, bad or good
    w = counts.astype(np.float64)
    start = np.array([0.01, 0.30])[:, None] * np.ones(patterns.shape[1])
    rates, prior = start, 0.85
    post = np.full(len(patterns), prior)
    for _ in range(rounds):
        log = np.einsum("pkv,ckv->pc", votes, np.log(np.stack([rates, 1 - rates], 2)))
        now = 1 / (1 + np.exp(np.clip(log[:, 1] + np.log(1 - prior) - log[:, 0] - np.log(prior), -700, 700)))
        each = np.stack([w * now, w * (1 - now)])
        cast = np.einsum("cp,pkv->ckv", each, votes)
        rates = (cast[:, :, 0] + 5 * start) / (cast.sum(2) + 5)
        rates = np.stack([np.minimum(rates[0], FALSE_ALARM), np.maximum(rates[1], SHARE)])
        prior = float(np.clip((each[0].sum() + 8.5) / (w.sum() + 10), 0.01, 0.99))
        done = np.abs(now - post).max(initial=0) < 1e-9
        post = now
        if done:
            break
    return post, rates, prior


class Scorer:
    def __init__(self):
        self.weight, self.bias = np.zeros(WIDTH), 0.0

    def logits(self, m: Measures) -> np.ndarray:
        doc, column, value = m.features()
        return np.bincount(doc, self.weight[column] * value, len(m.n)) + self.bias

    def train(self, features: tuple[np.ndarray, np.ndarray, np.ndarray], target: np.ndarray, weight: np.ndarray) -> None:
        """Logistic regression on soft labels, by Adam over all of the sample."""
        doc, column, value = features
        n = len(target)
        m1, m2, b1, b2 = np.zeros(WIDTH), np.zeros(WIDTH), 0.0, 0.0
        total = max(weight.sum(), 1e-9)
        for t in range(1, PASSES * 10 + 1):
            p = 1 / (1 + np.exp(-np.clip(np.bincount(doc, self.weight[column] * value, n) + self.bias, -30, 30)))
            d = (p - target) * weight / total
            g = np.bincount(column, d[doc] * value, WIDTH) + 1e-5 * self.weight
            gb = d.sum()
            m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
            b1, b2 = 0.9 * b1 + 0.1 * gb, 0.99 * b2 + 0.01 * gb * gb
            a, c = 1 - 0.9**t, 1 - 0.99**t
            self.weight -= 0.1 * (m1 / a) / (np.sqrt(m2 / c) + 1e-6)
            self.bias -= 0.1 * (b1 / a) / (np.sqrt(b2 / c) + 1e-6)


def _texts(b: pd.DataFrame) -> list[str | None]:
    return [x if isinstance(x, str) else None for x in b["text"]]


def patterns_of(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The patterns of votes over all documents, and how many have each."""

    def work(batches):
        for b in batches:
            texts = _texts(b)
            codes = [Measures(texts[lo:hi]).votes() for lo, hi in parts(texts)]
            each, n = np.unique(np.concatenate(codes), axis=0, return_counts=True)
            yield pd.DataFrame({"votes": list(each.astype(np.int32)), "n": n})
        release()

    found = docs.select(F.col("text").cast("string").alias("text")).mapInPandas(work, "votes array<int>, n long").groupBy("votes").agg(F.sum("n").alias("n")).orderBy("votes").collect()
    return np.array([r.votes for r in found], np.int8).reshape(-1, len(LABELLERS)), np.array([r.n for r in found], np.int64)


def _learned(batches):
    """Votes and features of the sample's texts, equal columns of a text summed."""
    for b in batches:
        texts = _texts(b)
        for lo, hi in parts(texts):
            m = Measures(texts[lo:hi])
            doc, column, value = m.features()
            keys, at = np.unique(doc.astype(np.int64) * WIDTH + column, return_inverse=True)
            total = np.bincount(at, value, len(keys)).astype(np.float32)
            cut = np.searchsorted(keys, np.arange(hi - lo + 1) * WIDTH)
            low = (keys % WIDTH).astype(np.uint16)
            yield pd.DataFrame({"h": b["h"].to_numpy()[lo:hi], "votes": list(m.votes().astype(np.int32)), "columns": [low[i:j].tobytes() for i, j in zip(cut, cut[1:], strict=False)], "values": [total[i:j].tobytes() for i, j in zip(cut, cut[1:], strict=False)]})
    release()


def fit(docs: DataFrame) -> Scorer:
    patterns, counts = patterns_of(docs)
    post, _, _ = estimate(patterns, counts)
    few = docs.select(F.col("text").cast("string").alias("text"), F.col("doc_id").cast("string").alias("id")).where("text is not null")
    # keys first, texts of a bounded number of keys after
    h = F.xxhash64("id", "text")
    edge = few.select(h.alias("h")).orderBy("h").limit(SAMPLE).agg(F.max("h")).first()[0]
    scorer = Scorer()
    if edge is None:
        return scorer
    # what the executors send is features and votes rather than texts
    found = few.where(h <= edge).select(h.alias("h"), "text").mapInPandas(_learned, "h long, votes array<int>, columns binary, values binary").orderBy("h", F.xxhash64("columns", "values")).limit(SAMPLE).collect()
    own = np.array([r.votes for r in found], np.int8).reshape(-1, len(LABELLERS))
    columns = [np.frombuffer(r["columns"], np.uint16) for r in found]
    features = np.repeat(np.arange(len(found), dtype=np.int32), [len(c) for c in columns]), np.concatenate(columns), np.concatenate([np.frombuffer(r["values"], np.float32) for r in found])
    del found, columns
    # each vote row finds its pattern's posterior
    code = lambda v: (v.astype(np.int64) + 1) @ (3 ** np.arange(len(LABELLERS)))
    order = np.argsort(code(patterns))
    at = order[np.searchsorted(code(patterns)[order], code(own))]
    target = post[at]
    sure = np.abs(2 * target - 1) * (np.abs(own).sum(1) > 0)
    share = float((target * sure).sum() / max(sure.sum(), 1e-9))
    # both classes weigh the same, within reason
    balance = target * np.clip(0.5 / max(share, 1e-9), 0.5, 5) + (1 - target) * np.clip(0.5 / max(1 - share, 1e-9), 0.5, 5)
    scorer.train(features, target, sure * balance)
    return scorer


def scoring(spark: SparkSession, scorer: Scorer) -> Callable[[Column], Column]:
    """A function of a text column that gives its score: of being good, 0 to 1; a null or wordless text has 0.

    Only that column goes to Python and nothing is shuffled, so each row carries its own verdict.
    """
    held = spark.sparkContext.broadcast(scorer)  # of fixed size

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            texts = [x if isinstance(x, str) else None for x in b]
            out = np.zeros(len(texts))
            for lo, hi in parts(texts):
                m = Measures(texts[lo:hi])
                out[lo:hi] = np.where(m.n > 0, 1 / (1 + np.exp(-np.clip(held.value.logits(m), -30, 30))), 0)
            yield pd.Series(out)
        release()

    return lambda text: score(text.cast("string"))


def with_scores(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """``docs`` with score, as ``scoring`` tells, and kept (score >= 0.5) beside their other columns. Columns named as the two are replaced."""
    score = scoring(docs.sparkSession, scorer)
    return docs.drop("score", "kept").withColumn("score", score(F.col("text"))).withColumn("kept", F.col("score") >= 0.5)


def score_documents(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """Per row of ``docs``: doc_id, and score and kept as ``with_scores`` tells.

    Rows that repeat a doc_id, or lack one, are scored each. Only doc_id and text are read.
    """
    rows = with_scores(docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text"), scorer)
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "score", "kept")
