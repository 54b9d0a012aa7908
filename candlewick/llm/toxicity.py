"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is a hashed word embedding beside the mean of hashed embeddings of its
character 3- to 5-grams, with marks for its ends; so unseen forms of a known stem count.
Words are runs of letters, digits and non-ASCII characters, lower-cased. A text is read
in windows of ``WINDOW`` words that overlap by a quarter; all are scored, and a text's
score is its highest window's. Training takes each text's window that scores highest
(texts are labelled, windows aren't), of negative ones a random one as well.

Labels come from at most ``SAMPLE`` rows of each class, those with the least hash of
their doc_id, and from their whole texts, however long; the sample is all that reaches
the driver. Scoring is one scan without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import parts, release
from .words import join_bytes, mix, segment_hashes, word_spans

WINDOW, STRIDE = 48, 36
HIDDEN, WORD_DIM, CHAR_DIM = 8, 8, 12
WORD_ROWS, CHAR_ROWS = 1 << 15, 1 << 16
SAMPLE = 1500
STEPS, BATCH, RATE = 500, 64, 0.01
#: The row of an embedding with the steepest gradient moves ROW_RATE times as far as a weight does.
ROW_RATE = 120
#: Words and n-grams of fewer training texts keep a row of zeros.
LEAST_WORD, LEAST_GRAM = 8, 25

_GAP = np.ones(256, bool)
_GAP[[*range(48, 58), *range(97, 123), *range(128, 256)]] = False


class Vocabulary:
    """The distinct words of some texts: their word rows and the rows of their character n-grams."""

    def __init__(self, texts: list[str | None]):
        buf, at = join_bytes([(t or "").lower().encode("utf-8", "surrogatepass") for t in texts])
        starts, ends = word_spans(buf, _GAP)
        h = segment_hashes(buf, starts, ends)
        self.offsets = np.searchsorted(starts, at)
        once, first, self.words = np.unique(h, return_index=True, return_inverse=True)
        self.rows = (once % np.uint64(WORD_ROWS)).astype(np.int64)
        # each distinct word once more, between marks
        s, n = starts[first], ends[first] - starts[first]
        end = np.cumsum(n + 2)
        marked = np.full(int(end[-1]) if len(end) else 0, 60, np.uint8)
        marked[end - 1] = 62
        inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        marked[np.repeat(end - n - 1, n) + inner] = buf[np.repeat(s, n) + inner]
        own = np.repeat(np.arange(len(n), dtype=np.int32), n + 2)
        grams, owners = [], []
        x = marked.astype(np.uint64)
        with np.errstate(over="ignore"):
            for k in (3, 4, 5):
                if len(x) < k:
                    continue
                v = np.full(len(x) - k + 1, k, np.uint64)
                for i in range(k):
                    v = v * np.uint64(257) + x[i : len(x) - k + 1 + i]
                whole = own[: len(v)] == own[k - 1 :]
                grams.append((mix(v[whole]) % np.uint64(CHAR_ROWS)).astype(np.int32))
                owners.append(own[: len(v)][whole])
        g = np.concatenate(grams) if grams else np.zeros(0, np.int32)
        o = np.concatenate(owners) if owners else np.zeros(0, np.int32)
        order = np.argsort(o, kind="stable")
        self.grams = g[order]
        self.count = np.bincount(o, minlength=len(n))  # at least one: a word of one byte has the gram with both marks
        self.begin = np.cumsum(self.count) - self.count

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(WINDOW, windows) word numbers, -1 beyond the end, and each window's text. A text without words has none."""
        n = np.diff(self.offsets)
        k = np.where(n > 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)), 0)
        doc = np.repeat(np.arange(len(n)), k)
        at = (np.arange(len(doc)) - np.repeat(np.cumsum(k) - k, k)) * STRIDE
        place = at + np.arange(WINDOW)[:, None]
        good = place < n[doc]
        flat = np.where(good, place + self.offsets[:-1][doc], 0)
        return np.where(good, self.words[flat] if len(self.words) else 0, -1), doc


def _sig(x):
    return np.float32(0.5) * (np.float32(1) + np.tanh(np.float32(0.5) * x))


class Network:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        f = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        h, d = HIDDEN, WORD_DIM + CHAR_DIM
        # near zero: what training never saw says nothing
        self.word = (r.standard_normal((WORD_ROWS, WORD_DIM)) * 0.01).astype(np.float32)
        self.char = (r.standard_normal((CHAR_ROWS, CHAR_DIM)) * 0.01).astype(np.float32)
        self.p = {"att": f(2 * h, 2 * h), "att_v": f(2 * h), "out": f(2 * h), "bias": np.zeros(1, np.float32)}
        for k in ("f", "b"):
            self.p |= {"w" + k: f(d, 3 * h), "c" + k: np.zeros(3 * h, np.float32), "u" + k: f(h, 2 * h), "n" + k: f(h, h)}
        self.empty = 0.0
        self.moments = None

    def frequent(self, v: Vocabulary) -> None:
        """Turns off the rows of what few of these texts hold."""
        text = np.repeat(np.arange(len(v.offsets) - 1), np.diff(v.offsets))
        df = np.bincount(np.unique(text * len(v.rows) + v.words) % len(v.rows), minlength=len(v.rows))
        word = np.bincount(v.rows, df, WORD_ROWS) >= LEAST_WORD
        char = np.bincount(v.grams, np.repeat(df, v.count), CHAR_ROWS) >= LEAST_GRAM
        self.word[~word] = 0
        self.char[~char] = 0
        self.moments = {k: [np.zeros_like(x), np.zeros_like(x)] for k, x in self.p.items()} | {"steps": 0, "word_on": word, "char_on": char}
        self.moments |= {"word": 1e-12, "char": 1e-12}

    def inputs(self, v: Vocabulary) -> np.ndarray:
        """Inputs of the distinct words."""
        if not len(v.rows):
            return np.zeros((0, WORD_DIM + CHAR_DIM), np.float32)
        chars = np.add.reduceat(self.char[v.grams], v.begin) / v.count[:, None].astype(np.float32)
        return np.concatenate([self.word[v.rows], chars], 1)

    def gates(self, x: np.ndarray) -> dict:
        """Each distinct word's share of the gates; a row of zeros at the end stands for -1."""
        return {k: np.concatenate([x @ self.p["w" + k] + self.p["c" + k], np.zeros((1, 3 * HIDDEN), np.float32)]) for k in "fb"}

    def forward(self, gates: dict, idx: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Logits of windows (columns of idx)."""
        h2, (steps, n) = 2 * HIDDEN, idx.shape
        on = (idx >= 0).astype(np.float32)
        states = np.zeros((steps, n, h2), np.float32)
        for k, order, at in (("f", range(steps), 0), ("b", range(steps - 1, -1, -1), HIDDEN)):
            g, u, un = gates[k], self.p["u" + k], self.p["n" + k]
            h = np.zeros((n, HIDDEN), np.float32)
            for t in order:
                x = g[idx[t]]
                zr = _sig(x[:, :h2] + h @ u)
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                new = np.tanh(x[:, h2:] + (r * h) @ un)
                m = on[t, :, None] * (1 - z)
                if keep is not None:
                    keep.append((k, t, h, z, r, new))
                h = h + m * (new - h)
                states[t, :, at : at + HIDDEN] = h
        a = np.tanh(states @ self.p["att"])
        e = np.where(idx >= 0, a @ self.p["att_v"], np.float32(-1e9))
        w = np.exp(e - e.max(0))
        w /= w.sum(0)
        pooled = np.einsum("tn,tnh->nh", w, states)
        if keep is not None:
            keep.append((states, a, w, pooled, on))
        return pooled @ self.p["out"] + self.p["bias"]

    def step(self, v: Vocabulary, idx: np.ndarray, y: np.ndarray, weight: np.ndarray, rate: float) -> None:
        """One step of gradient descent on the windows of idx."""
        x, keep = self.inputs(v), []
        logit = self.forward(self.gates(x), idx, keep)
        states, a, w, pooled, on = keep.pop()
        p, h2, n = self.p, 2 * HIDDEN, idx.shape[1]
        d = ((_sig(logit) - y) * weight / weight.sum()).astype(np.float32)
        grad = {"bias": d.sum(keepdims=True), "out": pooled.T @ d}
        dpool = d[:, None] * p["out"]
        dw = np.einsum("nh,tnh->tn", dpool, states)
        de = w * (dw - (w * dw).sum(0))
        grad["att_v"] = np.einsum("tn,tnh->h", de, a)
        da = de[:, :, None] * p["att_v"] * (1 - a * a)
        grad["att"] = states.reshape(-1, h2).T @ da.reshape(-1, h2)
        ds = w[:, :, None] * dpool + da @ p["att"].T
        dx = np.zeros_like(x)
        for k, at in (("f", 0), ("b", HIDDEN)):
            u, un = p["u" + k], p["n" + k]
            gu, gn = np.zeros_like(u), np.zeros_like(un)
            dg = np.zeros((idx.shape[0], n, 3 * HIDDEN), np.float32)
            dh = np.zeros((n, HIDDEN), np.float32)
            for kk, t, h, z, r, new in reversed([s for s in keep if s[0] == k]):
                dh = dh + ds[t, :, at : at + HIDDEN]
                m = on[t, :, None]
                dnew = dh * m * (1 - z) * (1 - new * new)
                dz = -dh * m * (new - h) * z * (1 - z)
                drh = dnew @ un.T
                dr = drh * h * r * (1 - r)
                dzr = np.concatenate([dz, dr], 1)
                gu += h.T @ dzr
                gn += (r * h).T @ dnew
                dg[t] = np.concatenate([dzr, dnew], 1)
                dh = dh * (1 - m * (1 - z)) + drh * r + dzr @ u.T
            grad["u" + k], grad["n" + k] = gu, gn
            flat, rows = idx.ravel(), dg.reshape(-1, 3 * HIDDEN)
            good = flat >= 0
            order = np.argsort(flat[good], kind="stable")
            own, first = np.unique(flat[good][order], return_index=True)
            per_word = np.add.reduceat(rows[good][order], first)
            grad["w" + k], grad["c" + k] = x[own].T @ per_word, per_word.sum(0)
            dx[own] += per_word @ p["w" + k].T
        self._adam(grad, rate)
        used = np.flatnonzero(np.abs(dx).sum(1))
        self._rows(self.word, "word", v.rows[used], dx[used, :WORD_DIM], rate)
        n_grams = v.count[used]
        place = np.repeat(v.begin[used] - np.cumsum(n_grams) + n_grams, n_grams) + np.arange(int(n_grams.sum()))
        share = np.repeat(dx[used, WORD_DIM:] / n_grams[:, None].astype(np.float32), n_grams, 0)
        self._rows(self.char, "char", v.grams[place], share, rate)

    def _adam(self, grad: dict, rate: float) -> None:
        self.moments["steps"] += 1
        t = self.moments["steps"]
        for k, g in grad.items():
            m, s = self.moments[k]
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            self.p[k] -= (rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)).astype(np.float32)

    def _rows(self, table: np.ndarray, name: str, rows: np.ndarray, g: np.ndarray, rate: float) -> None:
        """A step on the rows used."""
        on = self.moments[name + "_on"][rows]
        rows, g = rows[on], g[on]
        if not len(rows):
            return
        order = np.argsort(rows, kind="stable")
        own, first = np.unique(rows[order], return_index=True)
        g = np.add.reduceat(g[order], first)
        # steps in proportion to the gradient, so rows that many windows agree on outrun the rest
        norm = float(np.sqrt((g * g).sum(1).max()))
        self.moments[name] = max(norm, 0.9 * self.moments[name])
        table[own] -= ROW_RATE * rate / self.moments[name] * g

    def logits(self, v: Vocabulary, windows: np.ndarray) -> np.ndarray:
        gates = self.gates(self.inputs(v))
        out = [self.forward(gates, windows[:, lo : lo + 2048]) for lo in range(0, windows.shape[1], 2048)]
        return np.concatenate(out) if out else np.zeros(0, np.float32)

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Of each text, its highest window's; without words, the share of label 1 in training, below 0.5."""
        v = Vocabulary(texts)
        windows, doc = v.windows()
        top = np.full(len(texts), -np.inf)
        np.maximum.at(top, doc, self.logits(v, windows).astype(np.float64))
        return np.where(np.isneginf(top), self.empty, 1 / (1 + np.exp(-np.clip(top, -30, 30))))

    def bare(self) -> Network:
        """Without what only training needs."""
        self.moments = None
        return self


def train(texts: list[str | None], labels: np.ndarray, steps: int = STEPS, seed: int = 7) -> Network:
    """With labels of one kind only, or none, every score is that label's share (0 at most 0.49 for an empty text)."""
    net, r = Network(seed), np.random.default_rng(seed)
    y = np.asarray(labels, np.float32)
    net.empty = float(min(y.mean(), 0.49)) if len(y) else 0.0
    if not len(y) or y.min() == y.max():
        net.p["out"][:] = 0
        net.p["bias"][:] = 30 if len(y) and y[0] == 1 else -30
        return net.bare()
    v = Vocabulary(texts)
    windows, doc = v.windows()
    if not len(doc):
        return net.bare()
    net.frequent(v)
    share = float(y.mean())
    few = np.flatnonzero(np.bincount(doc, minlength=len(y))[doc] <= 4)  # at first all windows of short texts
    step = 0
    while step < steps:
        if step == 0 and len(few):
            chosen = few
        else:
            logit = net.logits(v, windows)
            order = np.lexsort((-logit, doc))
            best = order[np.unique(doc[order], return_index=True)[1]]
            other = r.permutation(len(doc))
            other = other[np.unique(doc[other], return_index=True)[1]]
            chosen = np.unique(np.concatenate([best, other[y[doc[other]] == 0]]))
        r.shuffle(chosen)
        label = y[doc[chosen]]
        weight = np.where(label == 1, (1 - share), share).astype(np.float32) * 2
        for lo in range(0, len(chosen), BATCH):
            c = chosen[lo : lo + BATCH]
            idx = windows[:, c]
            own = np.unique(idx)
            own = own[own >= 0]
            net.step(_Part(v, own), _renumber(idx, own), label[lo : lo + BATCH], weight[lo : lo + BATCH], RATE * (1 - 0.9 * min(1, step / steps)))
            step += 1
    return net.bare()


def _renumber(idx: np.ndarray, own: np.ndarray) -> np.ndarray:
    return np.where(idx >= 0, np.searchsorted(own, idx), -1)


class _Part:
    """Some words of a vocabulary."""

    def __init__(self, v: Vocabulary, own: np.ndarray):
        self.rows, self.count = v.rows[own], v.count[own]
        self.begin = np.cumsum(self.count) - self.count
        self.grams = v.grams[np.repeat(v.begin[own] - self.begin, self.count) + np.arange(int(self.count.sum()))]


def sample(docs: DataFrame, labels: DataFrame, label: str) -> pd.DataFrame:
    """Up to SAMPLE whole texts of each class, of the rows whose crc32(doc_id as text) mod 5 is not 0.

    A doc_id with both labels counts as 1; of one with several texts, that of the least hash
    counts. Labels without a document take no place in the sample.
    """
    known = labels.where(f"doc_id is not null and {label} in (0, 1) and crc32(cast(cast(doc_id as long) as string)) % 5 <> 0")
    known = known.groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.max(label).cast("int").alias("y"))
    texts = docs.select(F.col("doc_id").cast("long").alias("__id"), F.col("text").cast("string").alias("text")).where("__id is not null")
    # numbers first, so that only the sample's texts are moved
    there = known.join(texts.groupBy("__id").agg(F.min(F.xxhash64("text")).alias("__t")), "__id").withColumn("__h", F.xxhash64("__id"))
    top = [there.where(F.col("y") == y).orderBy("__h", "__id").limit(SAMPLE) for y in (0, 1)]
    few = top[0].unionByName(top[1]).withColumnRenamed("__t", "__least")  # at most 2 * SAMPLE rows are broadcast
    rows = texts.join(F.broadcast(few), "__id").where(F.xxhash64("text") == F.col("__least")).dropDuplicates(["__id"])
    return rows.select("text", "y", "__h").toPandas().sort_values(["__h", "text"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Network:
    rows = sample(docs, labels, label)
    return train(list(rows["text"]), rows["y"].to_numpy())


def score_documents(docs: DataFrame, net: Network) -> DataFrame:
    """Per row of ``docs``: doc_id, score (0 to 1, to six places) and predicted (1 if score >= 0.5, else 0).

    The score depends on the text alone: a null or wordless text gets the share of label 1
    in training, at most 0.49. Rows that repeat a doc_id, or lack one, are scored each.
    Only doc_id and text are read.
    """
    held = docs.sparkSession.sparkContext.broadcast(net)  # of fixed size

    def work(batches):
        net = held.value
        for b in batches:
            texts = [x if isinstance(x, str) else None for x in b["text"]]
            score = np.zeros(len(b))
            for lo, hi in parts(texts, 1_500_000):
                # single precision: beyond six places a score depends on what is scored along with it
                score[lo:hi] = net.score(texts[lo:hi]).round(6)
            yield pd.DataFrame({"doc_id": b["doc_id"], "score": score, "predicted": (score >= 0.5).astype(np.int32)})
        release()

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = rows.mapInPandas(work, "doc_id string, score double, predicted int")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))
