"""Each method against brute force, exact round trips or held-out accuracy."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from candlewick.llm import cover_tree, decontamination, lines, minhash, packing, quality, registry, sharding, token_files, tokens, toxicity, url_filter, words
from candlewick.llm.shared import components, spanning

SF = "/root/testdata/sf0.001"
PATH = registry.tokenizer_path()


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def roots(nodes, links):
    up = {n: n for n in nodes}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_queries_equal_their_sql(spark, name):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = entry.queries()[name](spark, SF).toPandas(), c.sql(entry.oracle_sql()[name]).df()
    cols = sorted(got.columns)
    text = lambda df: sorted(map(str, df[cols].astype(object).where(df[cols].notna(), None).values.tolist()))
    assert cols == sorted(want.columns) and text(got) == text(want)


def test_components_of_chains_and_stars(spark):
    r = random.Random(2)
    links = [(i, i + 1) for i in range(100, 400)] + [(500, i) for i in range(501, 700)] + [(2000 + i % 3, i) for i in range(3000, 6000)] + [(2000, 2001)] + [(r.randrange(1000, 1200), r.randrange(1000, 1200)) for _ in range(150)] + [(7, 7)]
    r.shuffle(links)
    got = {x.node: x.component for x in components(spark.createDataFrame(links, "u long, v long").repartition(13)).collect()}
    want = roots({n for e in links for n in e}, links)
    assert got == {n: c for n, c in want.items() if n in got} and set(want) - set(got) <= {n for n in want if want[n] == n}
    u, v = spanning(np.array([3, 1, 9]), np.array([2, 2, 8]))
    assert sorted(zip(u.tolist(), v.tolist(), strict=True)) == [(2, 1), (3, 1), (9, 8)]


def test_words_and_shingles():
    texts = ["A b  C\td", "a b c", None, "", "x", "É é", "q " * 200_000 + "end"]
    for size in (3, 5):
        for t, got in zip(texts, words.shingles(texts, size), strict=True):
            w = (t or "").encode().lower().split()
            want = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
            assert len(got) == len(want)
    a, b = words.shingles(["one two three four", "x one TWO three\nfour y"], 3)
    assert words.overlap(a, b) == 2


@pytest.mark.parametrize("block", [4096, 130])
def test_near_copies_of_a_crowd(spark, monkeypatch, block):
    """A chain of edits, beyond a region's size, in which only some pairs link."""
    monkeypatch.setattr(minhash, "BLOCK_DOCS", block)
    monkeypatch.setattr(minhash, "CROWD_BLOCK", block)
    r = random.Random(3)
    base = [f"w{i}" for i in range(90)]
    texts = []
    for i in range(900):
        t = list(r.choice(texts[-40:]).split()) if texts else base
        for _ in range(r.randrange(0, 4)):
            t[r.randrange(len(t))] = f"z{r.randrange(10**6)}"
        texts.append(" ".join(t))
    texts += ["boiler plate line that many share " + " ".join(f"u{i}_{k}" for k in range(r.randrange(2, 9))) for i in range(900)]
    got = {x.doc_id: x.component_id for x in minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 3, 85).collect()}
    s = [{tuple(t.split()[i : i + 3]) for i in range(len(t.split()) - 2)} for t in texts]
    links = [(i, j) for i in range(len(s)) for j in range(i) if 100 * len(s[i] & s[j]) >= 85 * len(s[i] | s[j])]
    want = roots(range(len(texts)), links)
    assert len(set(want.values())) > 5 and len(links) > 1000
    assert got == want


@pytest.mark.parametrize("tasks", ["4", "23"])
def test_linked_pairs_within_a_crowd(spark, monkeypatch, tasks):
    """Documents that share every tree's region and nothing deeper; each tenth agrees with the next as a linked pair may."""
    monkeypatch.setattr(minhash, "CROWD_BLOCK", 150)
    g = np.random.default_rng(5)
    sig = g.integers(0, 1 << 16, (1400, 120), dtype=np.uint16)
    sig[:, :40] = sig[0, :40]
    sig[1::10, 40:100] = sig[::10, 40:100]
    sig = sig[g.permutation(len(sig))]
    rows = [(i, s.tobytes(), (s & 0xFF).astype(np.uint8).tobytes(), list(range(minhash.TREES))) for i, s in enumerate(sig)]
    reps = spark.createDataFrame(rows, "doc_id long, sig binary, low binary, regions array<long>")
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(tasks == "4").lower())
    try:
        found = {(x.u, x.v) for x in minhash.forest(reps, 0.69, 5).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    same = minhash.agreement(sig, sig) >= 0.69
    assert found == {(i, j) for i, j in zip(*np.nonzero(same), strict=True) if i < j} and len(found) == 140


def test_regions_along_an_order(spark):
    """Runs of equal prefixes, cut anywhere by ranges and batches, come out whole."""
    r = random.Random(4)
    sizes = [1, 2, 700, 1, 1500, 3, 1]
    rows = [(k, sum(sizes[:k]) + i) for k, n in enumerate(sizes) for i in range(n)]
    for cuts in ([], [1], [3, 500, 1500], sorted(r.sample(range(len(rows)), 40))):
        batches = [pd.DataFrame(rows[a:b], columns=["region", "doc_id"]) for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True)]
        from unittest import mock

        with mock.patch.object(minhash.TaskContext, "get") as get:
            get.return_value.partitionId.return_value = 0
            out = pd.concat(minhash.walk(iter(batches)))
        assert out["doc_id"].tolist() == [i for k, i in rows if sizes[k] > 1 or k in (0, 6)] and not out["doc_id"].duplicated().any()
        assert (out.groupby("region")["place"].max() + 1).to_dict() == {k: n for k, n in enumerate(sizes) if n > 1 or k in (0, 6)}
        assert out.groupby("meet").size().max() <= minhash.REGION and (out["crowd"] == out["region"].isin([2, 4])).all()
        # each meets the REGION / 2 neighbours before and after it
        crowd = out[out["region"] == 4].reset_index()
        assert all((crowd["meet"][i] == crowd["meet"][j]) or (crowd["again"][i] == crowd["again"][j]) for i in range(0, 1500, 7) for j in range(i, min(i + minhash.REGION // 2, 1500), 50))


def test_cover_tree_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(cover_tree, "BLOCK", 150)
    g = np.random.default_rng(1)
    centres = g.standard_normal((6, 24))
    x = np.concatenate([c + g.standard_normal((80, 24)) * s for c, s in zip(centres, (0.01, 0.1, 0.25, 0.3, 0.35, 2.0), strict=True)] + [np.repeat(centres[:1], 50, 0)])
    ids = g.permutation(len(x)).tolist()
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in cover_tree.near_vectors(df, 0.9).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    comp = roots(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near), strict=True)])
    assert got == {i: (int(near[k].sum()), comp[i]) for k, i in enumerate(ids)}


def test_dual_traversal_prunes(monkeypatch):
    """Clusters far from each other: few of all pairs are looked at, and none is lost."""
    g = np.random.default_rng(3)
    centres = g.standard_normal((60, 32))
    x = cover_tree._unit(np.concatenate([c + 0.02 * g.standard_normal((100, 32)) for c in centres]))
    order, path = cover_tree.grow(x)
    x = x[order]
    t = cover_tree.Tree(x, path, np.ones(len(x)))
    seen = [0]
    einsum = np.einsum

    def counted(how, a, b):
        seen[0] += len(a)
        return einsum(how, a, b)

    dense = cover_tree._dense

    def counted_dense(a, b, p, q, *rest):
        seen[0] += len(p) * len(q)
        return dense(a, b, p, q, *rest)

    monkeypatch.setattr(cover_tree.np, "einsum", counted)
    monkeypatch.setattr(cover_tree, "_dense", counted_dense)
    (si, _), (wi, wj) = cover_tree.dual(t, t, 0.9)
    monkeypatch.undo()
    n = t.end - t.begin
    whole = np.where(wi == wj, n[wi] * (n[wi] - 1) // 2, n[wi] * n[wj]).sum()
    assert len(si) + whole == (np.triu(x @ x.T, 1) >= 0.9).sum()
    assert seen[0] < len(x) ** 2 / 2 / 50


def test_planted_links_among_many_vectors(spark):
    g = np.random.default_rng(9)
    x = g.standard_normal((30_000, 48)).astype(np.float32)
    for k in range(200):  # 150 * k links to the row after it
        x[150 * k + 1] = x[150 * k] + 0.2 * g.standard_normal(48)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {(r.vec_id, r.component_id) for r in cover_tree.near_vectors(df, 0.9).where("n_links > 0").collect()}
    assert {150 * k for k in range(200)} == {c for i, c in got if i == c} and len(got) == 400


def test_lines_against_brute_force(spark):
    r = random.Random(1)
    base = ["".join(r.choice("abé ") for _ in range(r.choice((18, 18, 70, 200)))) + f"xyzzy{k}" for k in range(20)]

    def edit(x):
        i = r.randrange(len(x))
        return r.choice([x[:i] + x[i + 1 :], x[:i] + r.choice("abcé") + x[i + 1 :], x[:i] + r.choice("abcé") + x[i:]])

    docs = [(k - 30, "\n".join(edit(r.choice(base)) if r.random() < 0.7 else r.choice(base) for _ in range(r.randrange(0, 8)))) for k in range(70)]

    def near(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return a == b
        i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]

    seen, want = [], {}
    for k, t in docs:
        kept = []
        for x in t.split("\n"):
            if len(x.strip(" ")) < lines.MIN_CHARS:
                kept.append(x)
                continue
            if not any(near(x, y) for y in seen):
                kept.append(x)
            seen.append(x)
        want[k] = "\n".join(kept)
    for limit, long in ((lines.BROADCAST_ROWS, lines.LONG), (-1, 75)):
        was = lines.BROADCAST_ROWS, lines.LONG
        lines.BROADCAST_ROWS, lines.LONG = limit, long
        try:
            got = {x.doc_id: x.text for x in lines.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
        finally:
            lines.BROADCAST_ROWS, lines.LONG = was
        assert got == want


def test_line_dedup_runs_no_python(spark):
    plan = lines.dedup_lines(table(spark, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_ids_equal_the_library(spark):
    t = Tokenizer.from_file(PATH)
    r = random.Random(3)
    texts = ["".join(r.choice("ab 'sŚé\t\n　́\x1cͅİΣς.,%12<|endoftext|>AZ") for _ in range(30)) for _ in range(4000)]
    texts += [x.text for x in table(spark, "documents").collect()] + ["", " ", "\n", "a <|ENDOFTEXT|> b", "각 한국어", "a" * 30_000]
    e = tokens.Encoder(PATH)
    for _ in range(2):
        assert [d.tolist() for d in e.documents(texts, 9)] == [x.ids + [9] for x in t.encode_batch(texts, add_special_tokens=False)]
        e.forget()


def test_token_files_round_trip(spark):
    docs = table(spark, "documents")
    path, shards = token_files.write_tokens(docs, PATH, 1)
    got = token_files.read_tokens(spark, path, shards).orderBy("doc_id").collect()
    t, at = Tokenizer.from_file(PATH), 0
    for row, d in zip(got, docs.orderBy("doc_id").collect(), strict=True):
        ids = np.array(t.encode(d.text or "", add_special_tokens=False).ids + [1], "<u4")
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (d.doc_id, at, len(ids), zlib.crc32(ids))
        at += len(ids)
    one = shards.first()
    reader = token_files.ShardReader(f"{path}/{token_files.SHARD % one.shard}", token_files.get(f"{path}/dictionary"))
    k = int(reader.doc_ids[3])
    assert reader.find(k).tolist() == reader.ids(3).tolist() and reader.find(-99) is None
    with pytest.raises(ValueError):
        token_files.ShardReader(f"{path}/{token_files.SHARD % one.shard}", b"other")


def test_rendezvous_moves_few(spark):
    docs = table(spark, "documents").unionByName(table(spark, "documents").withColumn("doc_id", F.col("doc_id") + 10_000))
    got = sharding.assign(docs, [1.0, 2.0, 1.0]).collect()
    assert all(x.grown_shard in (x.shard, 3) for x in got) and any(x.grown_shard == 3 for x in got)
    n = Counter(x.shard for x in got)
    assert n[1] > 1.4 * max(n[0], n[2])
    for s in n:
        assert sorted(x.slot for x in got if x.shard == s) == list(range(n[s]))
    text = {x.doc_id: (x.text or "").encode() for x in docs.collect()}
    assert all(x.size == len(text[x.doc_id]) + 1 and x.text_crc32 == zlib.crc32(text[x.doc_id]) for x in got)
    fewer = {x.doc_id: x.shard for x in sharding.assign(docs.where("doc_id % 2 = 0"), [1.0, 2.0, 1.0]).collect()}
    assert all(fewer[x.doc_id] == x.shard for x in got if x.doc_id in fewer)
    with pytest.raises(ValueError):
        sharding.shard_of(docs["doc_id"], [])


def test_shards_computed_again(spark):
    import hashlib

    def draw(i, k):
        return -math.log((int(hashlib.md5(f"{i}/{k}".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52))

    got = registry.op6_sharding(spark, SF).collect()
    assert len(got) == table(spark, "documents").count()
    for r in got:
        score = [draw(r.doc_id, k) for k in range(17)]
        assert (r.shard, r.grown_shard) == (min(range(16), key=score.__getitem__), min(range(17), key=score.__getitem__))


def brute_edits(pattern, text):
    prev = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        cur = [i]
        for j, e in enumerate(text, 1):
            cur.append(min(prev[j - 1] + (c != e), prev[j] + 1, cur[-1] + 1))
        prev = cur
    return min(prev)


def test_edit_matching_against_dynamic_programming():
    r, hits = random.Random(5), 0
    for _ in range(250):
        item = decontamination.plain("".join(r.choice("abc ") for _ in range(r.randrange(1, 70))))
        if not item:
            continue
        x = list(item)
        for _ in range(r.randrange(0, 9)):
            i = r.randrange(len(x) + 1)
            x[i : i + r.randrange(0, 2)] = r.choice(["", "a", "c"])
        text = decontamination.plain("zz " * r.randrange(0, 9) + "".join(x) + " yy" * r.randrange(0, 5))
        edits = brute_edits(item, text)
        want = {1: edits} if edits <= int(decontamination.ERRORS * len(item)) else {}
        hits += bool(want)
        assert decontamination.Matcher([(1, item)], least=0).matches(text) == want
    assert hits > 80
    short = decontamination.Matcher([(1, "Paris, 1889."), (2, "yes")])
    assert short.matches("in PARIS 1889, they say") == {1: 0} and short.matches("Paris 1889") == {1: 0} and short.matches("parisx 1889 yesterday") == {}


def test_contamination_against_every_occurrence(spark):
    """Each document of the table against each item: dynamic programming where a fourth of the item's words occur."""
    docs, items = table(spark, "documents").collect(), [(r.item_id, decontamination.plain(r.text)) for r in table(spark, "benchmark").collect()]
    got = {r.doc_id: r for r in registry.op7_decontamination(spark, SF).collect()}
    assert len(got) == len(docs)
    pairs = 0
    for d in docs:
        t = decontamination.plain(d.text)
        words = set(t.split())
        want = {}
        for i, item in items:
            w = item.split()
            # an edit of each tenth character leaves most of ten words' parts; a document with none of an item's words is far
            if sum(x in words for x in w) * 4 < len(w):
                continue
            pairs += 1
            most = int(decontamination.ERRORS * len(item))
            edits = sellers(item, t)
            if edits <= most:
                want[i] = edits
        assert got[d.doc_id].item_ids == sorted(want) and got[d.doc_id].edits == min(want.values(), default=None)
    assert pairs > 20 and any(r.contaminated for r in got.values())


def sellers(pattern, text):
    """The least edits of an occurrence, a column of the table at a time."""
    p = np.frombuffer(pattern.encode("utf-32-le"), np.uint32)
    col, step = np.arange(len(p) + 1), np.arange(len(p) + 1)
    best = len(p)
    for c in np.frombuffer(text.encode("utf-32-le"), np.uint32):
        new = np.concatenate([[0], np.minimum(col[:-1] + (p != c), col[1:] + 1)])
        col = np.minimum.accumulate(new - step) + step
        best = min(best, int(col[-1]))
    return best


def test_benchmark_slices_agree(spark, monkeypatch):
    args = table(spark, "documents"), table(spark, "benchmark")
    key = lambda df: sorted((r.doc_id, tuple(r.item_ids), r.edits) for r in df.collect())
    whole = key(decontamination.contamination(*args))
    monkeypatch.setattr(decontamination, "SLICE", 3000)
    assert key(decontamination.contamination(*args)) == whole


def test_packing_fills_every_sequence(spark):
    r = np.random.default_rng(2)
    for n in (r.integers(1, 3000, 400), np.array([9000, 1, 4096, 4095]), np.array([1])):
        pieces = packing.pack(n)
        fill, spans = Counter(), {}
        for d, a, k, s, o in pieces:
            spans.setdefault(d, []).append((a, k))
            assert o == fill[s]
            fill[s] += k
        assert all(v == 4096 or v & (v - 1) == 0 for v in fill.values())
        for d, x in enumerate(n.tolist()):
            x0 = 0
            for a, k in sorted(spans[d]):
                assert a == x0 and k > 0
                x0 += k
            assert x0 == x
    even = packing.pack(np.concatenate([np.full(64, 2048), np.full(512, 256)]))
    costs = Counter()
    for _, _, k, s, _ in even:
        costs[s] += packing.cost(k)
    assert max(costs.values()) / min(costs.values()) < 1.05
    got = registry.op8_packing(spark, SF).collect()
    t = Tokenizer.from_file(PATH)
    ids = {d.doc_id: np.array(t.encode(d.text or "", add_special_tokens=False).ids + [2], "<u4") for d in table(spark, "documents").collect()}
    assert sum(x.length for x in got) == sum(map(len, ids.values()))
    assert all(x.ids_crc32 == zlib.crc32(ids[x.doc_id][x.start : x.start + x.length]) and x.doc_tokens == len(ids[x.doc_id]) for x in got)


def test_label_model_and_scorer(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    known = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality.score_documents(docs, quality.fit(docs)).join(known, "doc_id").toPandas()
    good, bad = got[got.quality == 1], got[got.quality == 0]
    assert good.kept.mean() > 0.99 and bad.kept.mean() < 0.1
    r = np.random.default_rng(1)
    y = r.random(20_000) < 0.9
    # each labeller sees one kind of bad text
    kind = r.integers(0, 3, len(y))
    votes = np.where(y[:, None], np.where(r.random((len(y), 3)) < 0.005, -1, 1), np.where(kind[:, None] == np.arange(3), -1, 1))
    p, n = np.unique(votes, axis=0, return_counts=True)
    post, rates, share = quality.estimate(p, n)
    at = {tuple(a): b for a, b in zip(p.tolist(), post, strict=True)}
    found = np.array([at[tuple(v)] for v in votes.tolist()]) >= 0.5
    assert (found == y).mean() > 0.97 and share > 0.5 and (rates[0] < rates[1]).all()
    assert quality.estimate(np.zeros((0, 8), np.int8), np.zeros(0))[2] > 0


def numeric(net, v, idx, y, k, i, eps=1e-3):
    def loss():
        z = net.forward(net.gates(net.inputs(v)), idx).astype(float)
        return float(np.mean(np.logaddexp(0, z) - y * z))

    flat = net.p[k].ravel()
    was = flat[i]
    flat[i] = was + eps
    hi = loss()
    flat[i] = was - eps
    lo = loss()
    flat[i] = was
    return (hi - lo) / (2 * eps)


def test_gradients_of_the_network():
    net = toxicity.Network(3)
    v = toxicity.Vocabulary(["some words in a text of a few words", "others"])
    net.word += 0.5 * np.random.default_rng(0).standard_normal(net.word.shape).astype(np.float32)
    idx, _ = v.windows()
    y = np.array([1, 0], np.float32)
    found = {}
    net._adam = lambda grad, rate: found.update(grad)
    net._rows = lambda *a: None
    net.step(v, idx, y, np.ones(2, np.float32), 0.1)
    for k in ("wf", "uf", "nf", "wb", "ub", "nb", "att", "att_v", "out", "cf"):
        for i in (0, 3):
            a, b = found[k].ravel()[i], numeric(net, v, idx, y, k, i)
            assert math.isclose(a, b, rel_tol=0.05, abs_tol=2e-4), (k, i, a, b)


def test_toxicity_on_held_out_texts():
    r = random.Random(8)
    clean = [f"{a}{b}" for a in "bcdfgklmnprst" for b in ("ano", "eri", "olu", "isk", "ump")]

    def text(toxic):
        w = [r.choice(clean) for _ in range(r.randrange(20, 150))]
        if toxic:
            for _ in range(3):
                w[r.randrange(len(w))] = r.choice(["vilewort", "nastoid", "zzgrob" + r.choice(clean)])
        return " ".join(w)

    y = np.array([i % 4 == 0 for i in range(800)], int)
    net = toxicity.train([text(t) for t in y[:600]], y[:600], steps=250)
    p = net.score([text(t) for t in y[600:]]) >= 0.5
    assert (p == y[600:]).mean() > 0.95
    long = " ".join(r.choice(clean) for _ in range(3000))
    assert net.score([long])[0] < 0.5 <= net.score([long + " vilewort nastoid vilewort"])[0]


def naive_score(net, text):
    """Word by word and window by window, each window's state by the gates' formulas."""
    import re

    found = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").lower().encode("utf-8", "surrogatepass"))
    if not found:
        return net.empty
    sig = lambda x: 1 / (1 + np.exp(-x))
    inputs = {}
    for w in set(found):
        h = int(words.segment_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0])
        marked, rows = b"<" + w + b">", []
        for k in (3, 4, 5):
            for i in range(len(marked) - k + 1):
                v = k
                for c in marked[i : i + k]:
                    v = (v * 257 + c) % (1 << 64)
                rows.append(int(words.mix(np.array([v], np.uint64))[0]) % toxicity.CHAR_ROWS)
        inputs[w] = np.concatenate([net.word[h % toxicity.WORD_ROWS], net.char[rows].mean(0)]).astype(float)
    p, n, top = net.p, toxicity.HIDDEN, -np.inf
    count = 1 + max(0, -(-(len(found) - toxicity.WINDOW) // toxicity.STRIDE))
    for s in range(count):
        window = found[s * toxicity.STRIDE : s * toxicity.STRIDE + toxicity.WINDOW]
        sides = []
        for k, order in (("f", window), ("b", window[::-1])):
            h, out = np.zeros(n), []
            for w in order:
                g = inputs[w] @ p["w" + k] + p["c" + k]
                zr = sig(g[: 2 * n] + h @ p["u" + k])
                z, r = zr[:n], zr[n:]
                h = z * h + (1 - z) * np.tanh(g[2 * n :] + (r * h) @ p["n" + k])
                out.append(h)
            sides.append(out if k == "f" else out[::-1])
        states = np.concatenate([np.array(sides[0]), np.array(sides[1])], 1)
        e = np.tanh(states @ p["att"]) @ p["att_v"]
        a = np.exp(e - e.max())
        top = max(top, float((a / a.sum()) @ states @ p["out"] + p["bias"][0]))
    return 1 / (1 + math.exp(-top))


def test_toxicity_of_the_table_word_by_word(spark):
    docs = table(spark, "documents")
    net = toxicity.fit(docs, table(spark, "labels"))
    got = {r.doc_id: r.score for r in toxicity.score_documents(docs, net).collect()}
    for r in docs.collect():
        assert math.isclose(got[r.doc_id], naive_score(net, r.text), abs_tol=2e-3)


def test_long_labelled_texts_are_learnt_from(spark):
    docs = spark.createDataFrame([(i, "a fair word " * 40_000 if i == 3 else f"text {i}") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    rows = toxicity.sample(docs, labels, "toxic")
    want = [i for i in range(20) if zlib.crc32(str(i).encode()) % 5]
    assert len(rows) == len(want) and rows["text"].str.len().max() == (480_000 if 3 in want else 7)


def test_label_model_document_by_document(spark):
    """Votes by plain loops over words; expectation-maximisation over documents rather than patterns; logits by summing weights."""
    texts = [r.text for r in table(spark, "documents").collect()]
    m = quality.Measures(texts)
    votes = m.votes()
    odd, end = set("#$%&*<>@[]\\^_`{|}~=+!"), set(".,;:?!\"')")
    for k, t in enumerate(texts):
        w = (t or "").encode("utf-8", "surrogatepass").split()
        if not w:
            assert not votes[k].any()
            continue
        chars = [[chr(c) for c in x] for x in w]
        low = [x.lower() for x in w]
        share = lambda flags, n=len(w): sum(flags) / n
        many = len(w) >= 40
        pairs = list(zip(low, low[1:], strict=False))
        want = {
            "odd": share(any(c in odd for c in x) for x in chars),
            "loud": share(sum("A" <= c <= "Z" for c in x) > 1 and sum("A" <= c <= "Z" for c in x) >= len(x) // 2 for x in chars),
            "same": share(a == b for a, b in pairs),
            "distinct": len(set(low)) / len(w) if many else None,
            "ended": share(x[-1] in end for x in chars) if many else None,
            "table": share(len(x) == 1 and x[0] in odd for x in chars),
            "repeats": (len(pairs) - len(set(pairs))) / len(w) if many else None,
            "digits": share(any("0" <= c <= "9" for c in x) for x in chars),
        }
        for j, (name, bad, good, below) in enumerate(quality.LABELLERS):
            v = want[name]
            vote = 0 if v is None else (-1 if v <= bad else 1 if v >= good else 0) if below else (-1 if v >= bad else 1 if v < good else 0)
            assert votes[k, j] == vote, (k, name, v, m.values[k, j])
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    post, rates, prior = quality.estimate(patterns, counts)
    start, q, p = (0.01, 0.30), [[0.01] * 8, [0.30] * 8], 0.85
    for _ in range(300):
        each = []
        for v in votes.tolist():
            like = [p, 1 - p]
            for c in (0, 1):
                for k, x in enumerate(v):
                    like[c] *= q[c][k] if x == -1 else 1 - q[c][k] if x == 1 else 1
            each.append(like[0] / sum(like))
        new = [[0.0] * 8, [0.0] * 8]
        for c in (0, 1):
            for k in range(8):
                bad, all_ = 5 * start[c], 5.0
                for v, e in zip(votes.tolist(), each, strict=True):
                    if v[k]:
                        w = e if c == 0 else 1 - e
                        bad, all_ = bad + w * (v[k] == -1), all_ + w
                new[c][k] = min(bad / all_, quality.FALSE_ALARM) if c == 0 else max(bad / all_, quality.SHARE)
        change = max(abs(a - b) for x, y in zip(q, new, strict=True) for a, b in zip(x, y, strict=True))
        q, p = new, min(max((sum(each) + 8.5) / (len(each) + 10), 0.01), 0.99)
        if change < 1e-12:
            break
    assert np.allclose(rates, q, atol=1e-6) and abs(prior - p) < 1e-6
    at = {tuple(a): b for a, b in zip(patterns.tolist(), post, strict=True)}
    assert np.allclose([at[tuple(v)] for v in votes.tolist()], each, atol=1e-6)
    scorer = quality.Scorer()
    scorer.weight, scorer.bias = np.random.default_rng(1).standard_normal(quality.WIDTH), 0.3
    total = [0.3] * len(texts)
    for d, c, v in zip(*(x.tolist() for x in m.features()), strict=True):
        total[d] += scorer.weight[c] * v
    assert np.allclose(scorer.logits(m), total, atol=1e-6)


def test_trust_over_links(spark):
    a = lambda *hs: "".join(f'<a href="https://{h}/p">x</a>' for h in hs)
    rows = [(1, "http://good.com/", a("friend.org", "friend.org", "both.org")), (2, "http://friend.org/", a("third.org")), (3, "http://links-to-bad.org/", a("x.net")), (4, "http://x.net/es/", a("both.org")), (5, "http://both.org/", a("x.net")), (6, "http://third.org/", ""), (7, "http://far.org/", a("links-to-bad.org")), (8, "http://alone.org/", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.host: r.verdict for r in url_filter.judge(df, registry.RULES).collect()}
    assert got == {"good.com": "allow", "friend.org": "allow", "links-to-bad.org": "block", "x.net": "block", "both.org": "allow", "third.org": "allow", "far.org": "block", "alone.org": "allow"}
    import duckdb

    c = duckdb.connect()
    pages = df.toPandas()
    c.register("pages", pages)
    want = dict(c.sql(f"SELECT host, verdict FROM ({url_filter.oracle_sql(registry.RULES)})").fetchall())
    assert got == want


def test_distrust_over_a_long_chain(spark):
    """Each host links to the next, the last to a blocked one; other blocked hosts, of which each has little mass."""
    a = lambda h: f'<a href="https://{h}/p">x</a>'
    rows = [(i, f"http://h{i}.org/", a(f"h{i + 1}.org" if i < 17 else "bad.net")) for i in range(18)]
    rows += [(100, "http://bad.net/es/", "")] + [(200 + i, f"http://b{i}.net/es/", "") for i in range(300)] + [(99, "http://alone.org/", a("else.org"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.host: r.verdict for r in url_filter.judge(df, registry.RULES).collect()}
    assert all(got[f"h{i}.org"] == "block" for i in range(18)) and got["alone.org"] == "allow"
    import duckdb

    c = duckdb.connect()
    c.register("pages", df.toPandas())
    assert got == dict(c.sql(f"SELECT host, verdict FROM ({url_filter.oracle_sql(registry.RULES)})").fetchall())


def test_pipeline_stages(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    at = docs
    for _, stage in cp.STAGES[:-1]:
        after = stage(spark, at, SF)
        assert after.columns == docs.columns
        after = cp.written(after, "test")
        assert 0.5 * at.count() < after.count() <= at.count()
        at = after
    kept = {r.doc_id: r.text for r in at.collect()}
    bench = [decontamination.plain(r.text) for r in table(spark, "benchmark").collect()]
    assert not any(b in decontamination.plain(t) for t in kept.values() for b in bench)
    long = [x for t in kept.values() for x in t.split("\n") if len(x.strip(" ")) >= lines.MIN_CHARS]
    assert len(long) == len(set(long))
    s = {i: set(x.tolist()) for i, x in zip(kept, words.shingles(list(kept.values()), 5), strict=True)}
    assert not any(100 * len(s[i] & s[j]) >= 80 * len(s[i] | s[j]) for i in s for j in s if i < j and s[i] and s[j])
    got = cp.run(spark, SF).collect()
    assert {r.doc_id for r in got} == set(kept)
    good = {r.doc_id for r in table(spark, "labels").where("quality = 1").collect()}
    scored = {r.doc_id for r in cp.quality_stage(spark, docs, SF).collect()}
    assert len(good & scored) > 0.97 * len(good)


def test_pipeline_against_brute_force(spark):
    """Each stage over plain lists; quality by the fitted scorer, items by the matcher, both of which have tests of their own."""
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = {r.doc_id for r in quality.score_documents(docs, quality.fit(docs)).where("kept").collect()}
    text = {r.doc_id: r.text for r in docs.orderBy("doc_id").collect() if r.doc_id in good}
    seen, by_size, after = set(), {}, {}

    def near(x):
        if x in seen:
            return True
        return any(one_edit(x, y) for n in (len(x) - 1, len(x), len(x) + 1) for y in by_size.get(n, ()))

    for i, t in text.items():
        kept = []
        for x in t.split("\n"):
            if len(x.strip(" ")) < lines.MIN_CHARS:
                kept.append(x)
                continue
            if not near(x):
                kept.append(x)
            if x not in seen:
                seen.add(x)
                by_size.setdefault(len(x), []).append(x)
        joined = "\n".join(kept)
        if joined == t or joined.split():
            after[i] = joined
    sets = dict(zip(after, words.shingles(list(after.values()), 5), strict=True))
    sets = {i: set(x.tolist()) for i, x in sets.items()}
    ids = [i for i in sets if sets[i]]
    root = roots(sets, [(i, j) for k, i in enumerate(ids) for j in ids[:k] if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])])
    match = decontamination.Matcher([(r.item_id, r.text) for r in table(spark, "benchmark").collect()])
    left = {i: after[i] for i in after if root[i] == i and not match.matches(after[i])}
    t = Tokenizer.from_file(PATH)
    want = {i: len(t.encode(x, add_special_tokens=False).ids) + 1 for i, x in left.items()}
    got = Counter()
    for r in cp.run(spark, SF).collect():
        got[r.doc_id] += r.length
    assert dict(got) == want and 0.5 * docs.count() < len(want) < docs.count()


def one_edit(a, b):
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]


def test_pipeline_judges_each_row(spark, monkeypatch):
    """Rows that repeat a doc_id, or lack one, get no other row's verdict."""
    import corpus_pipeline as cp

    docs = table(spark, "documents")
    scorer = quality.fit(docs)
    monkeypatch.setattr(quality, "fit", lambda _: scorer)
    verdict = quality.score_documents(docs, scorer).where("doc_id is not null").toPandas().set_index("doc_id")["kept"]
    text = {r.doc_id: r.text for r in docs.collect()}
    good, junk = (next(i for i, k in verdict.items() if k == x and text[i] and len(text[i].split()) > 3) for x in (True, False))
    item = next(r.text for r in table(spark, "benchmark").collect())
    line = "one line of more than sixteen characters, with some more words in it"
    make = lambda *rows: spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = lambda stage, *rows: sorted(((r.doc_id, r.text) for r in stage(spark, make(*rows), SF).collect()), key=str)
    a, b = text[good], text[junk]
    assert out(cp.quality_stage, (1, a), (1, b), (None, b), (None, a)) == sorted([(1, a), (None, a)], key=str)
    assert out(cp.line_stage, (5, line), (5, line), (None, line), (2, line), (None, "short")) == [(2, line), (None, "short")]
    assert out(cp.near_duplicate_stage, (None, a), (7, a), (7, a), (3, line), (3, a), (None, item), (None, item)) == sorted([(3, a), (3, line), (None, item)], key=str)
    assert out(cp.decontamination_stage, (1, line), (1, item), (None, item), (None, line)) == sorted([(1, line), (None, line)], key=str)
