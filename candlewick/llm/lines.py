"""Line dedup by a deletion-neighbourhood join, in DataFrame functions only.

Two lines are near if one insertion, deletion or replacement of a character turns one
into the other: if they are equal once one character at most is deleted from each. A
line of n characters has n + 1 such variants, each n long, which is too many to emit for
every line. But near lines also agree outside any stretch that holds the edit. So the
neighbourhood is emitted in rounds that lose nothing:

1. variants with a whole half deleted, 4 for each line, as 64-bit hashes. A line that shares none with a
   different line is near to no line, which is the case for nearly all;
2. of the others, variants with an eighth deleted, and of long lines then a 64th;
3. of what still shares one, the variants with one character of that stretch deleted.

Later variants are 128-bit hashes. Lines of equal length with the same variant at the same
place differ in that character alone, and a line that equals a longer one's variant is
one insertion away; so an aggregate for each variant finds the earliest line that is
near, without pairs of all lines that share it. ``levenshtein`` verifies each find.

Only hashes and positions are shuffled, and texts of the lines that get past round 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import written

MIN_CHARS = 16
ROUNDS = (2, 8, 64)
#: Characters from which a line goes through the last round too.
LONG = 2048


#: Rows up to which the lines that get past round 1 are broadcast, about 40 MB; more are joined by a shuffle.
BROADCAST_ROWS = 200_000
_SHIFT = 1 << 32


def _hash(*cols: Column) -> Column:
    """128 bits."""
    return F.struct(F.xxhash64(*cols).alias("a"), F.xxhash64(F.lit(0x5BD1E995), *cols).alias("b"))


def counts(line: Column) -> Column:
    """Whether a line is long enough to take part."""
    return F.length(F.trim(line)) >= MIN_CHARS


def exploded(docs: DataFrame) -> DataFrame:
    """(pos, line) of the lines that take part; pos orders by doc_id and place. One number, so that aggregates hash."""
    lines = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split(F.col("text").cast("string"), "\n", -1)).alias("line_no", "line"))
    pos = (F.col("doc_id").cast("decimal(20,0)") * F.lit(_SHIFT).cast("decimal(10,0)") + F.col("line_no").cast("decimal(10,0)")).cast("decimal(38,0)")
    return lines.where(counts(F.col("line"))).select(pos.alias("pos"), "line")


def first_places(docs: DataFrame) -> DataFrame:
    """(a, b, pos, k0 to k3): of each distinct line, by its hash, the earliest place and the variants of round 1.

    Those are the line with either half deleted, for lines of its length and of one
    character less or more. They follow from the line, so any row's will do.
    """
    n = F.length("line")
    keys = []
    for m in (n, n - 1):
        h = F.floor(m / 2).cast("int")
        keys += [F.xxhash64(m, F.lit(0), F.substring("line", F.lit(1), h)), F.xxhash64(m, F.lit(1), F.substring("line", n - m + h + 1, m - h))]
    rows = exploded(docs).select(F.xxhash64("line").alias("a"), F.xxhash64(F.lit(0x5BD1E995), "line").alias("b"), "pos", *[k.alias(f"k{i}") for i, k in enumerate(keys)])
    return rows.groupBy("a", "b").agg(F.min("pos").alias("pos"), *[F.min(f"k{i}").alias(f"k{i}") for i in range(4)])


def _stretches(parts: int) -> Column:
    """Of column ``line``: (m, p, lo, hi) for each stretch to delete.

    For a line and one of the same length (m) or of one character more or less (m the
    shorter's): stretch p leaves the first lo and the last hi characters.
    """
    n = F.length("line")
    one = lambda m: F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.struct(m.alias("m"), p.alias("p"), F.floor(m * p / parts).cast("int").alias("lo"), (m - F.floor(m * (p + 1) / parts)).cast("int").alias("hi")))
    return F.concat(one(n), one(n - 1))


def _variants(lines: DataFrame, parts: int) -> DataFrame:
    """(id, n, m, lo, hi, key) for each line, of n characters, and stretch; lines themselves stay where they are."""
    s = lines.select("id", "line", F.explode(_stretches(parts)).alias("s")).select("id", "line", "s.*")
    head, tail = F.substring("line", F.lit(1), F.col("lo")), F.substring("line", F.length("line") - F.col("hi") + 1, F.col("hi"))
    return s.select("id", F.length("line").alias("n"), "m", "lo", "hi", _hash(F.col("m"), F.col("p"), head, tail).alias("key"))


def _met(variants: DataFrame, line: str) -> DataFrame:
    """Keys of at least two different lines."""
    return variants.groupBy("key").agg(F.min(line).alias("x"), F.max(line).alias("y")).where("x <> y").select("key")


def shadowed(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """(a, b) of the distinct lines near to an earlier, different line. firsts: those of ``first_places``."""
    halves = firsts.select("a", F.explode(F.array("k0", "k1", "k2", "k3")).alias("key"))
    few = halves.join(_met(halves, "a"), "key", "left_semi").select("a").distinct()
    places = written(firsts.join(few, "a", "left_semi").select("a", "b", "pos"), "places")
    small = places.count() <= BROADCAST_ROWS
    at = (F.broadcast(places) if small else places).select("pos", F.struct("a", "b").alias("id"))
    some = written(exploded(docs).join(at, "pos").select("id", "line", "pos").where(F.col("id") == _hash(F.col("line"))).dropDuplicates(["id"]), "lines")
    hits = lambda v: v.join(_met(v, "id"), "key", "left_semi")
    # lines that may be near are told apart by the shorter's length, so both take part in the same round
    left = written(hits(_variants(some, ROUNDS[1])), "stretches")
    long = some.join(left.where(F.col("m") > LONG).select("id").distinct(), "id", "left_semi")
    left = left.where(F.col("m") <= LONG).unionByName(hits(_variants(long, ROUNDS[2]).where(F.col("m") > LONG)))
    cut = written(left.select("id", F.explode(F.sequence(F.col("lo") + 1, F.greatest(F.col("lo") + 1, F.col("n") - F.col("hi")))).alias("i")).distinct(), "cuts")
    line = some.join(cut.select("id").distinct(), "id", "left_semi")
    none = line.select("id", "pos", F.lit(0).alias("i"), _hash(F.col("line")).alias("key"))
    one = cut.join(line, "id").where("i <= length(line)").select("id", "pos", "i", _hash(F.expr("concat(substring(line, 1, i - 1), substring(line, i + 1))")).alias("key"))
    every = written(none.unionByName(one), "variants")
    earliest = F.min(F.struct("pos", "id")).alias("first")
    # replaced: the same variant at the same place
    swap = every.where("i > 0").join(every.where("i > 0").groupBy("key", "i").agg(earliest), ["key", "i"])
    # inserted: the whole shorter line is a longer one's variant; either can be the earlier
    whole = every.where("i = 0")
    longer = every.where("i > 0").join(whole.select("key", F.struct("pos", "id").alias("first")), "key")
    shorter = whole.join(every.where("i > 0").groupBy("key").agg(earliest), "key")
    found = [x.where("first.pos < pos").select("id", F.col("first.id").alias("first")) for x in (swap, longer, shorter)]
    found = found[0].unionByName(found[1]).unionByName(found[2]).distinct()
    texts = line.select("id", "line")
    both = found.join(texts, "id").join(texts.select(F.col("id").alias("first"), F.col("line").alias("earlier")), "first")
    return both.where(F.levenshtein("line", "earlier", 1).between(0, 1)).select("id.*").distinct()


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the text of its kept lines, and ``lines_before`` and ``lines_dropped``.

    A line (text between line feeds) of at least 16 characters, blanks around aside, is
    dropped if an equal or near line comes earlier, by doc_id and place in the text;
    whether that one is dropped itself is all the same. Shorter lines always stay. A
    null text stays null with 0 lines, an empty one has 1 line. A document may lose all
    its lines; its row stays, with an empty text. Rows with a null doc_id stay as they
    are. Of rows that repeat a doc_id, the same line at the same place counts as one.
    Other columns pass through; columns named as the two added ones are replaced.
    """
    firsts = written(first_places(docs), "firsts")
    gone = shadowed(docs, firsts)
    doc = F.floor(F.col("pos") / F.lit(_SHIFT).cast("decimal(10,0)"))
    place = F.struct((F.col("pos") - doc * F.lit(_SHIFT).cast("decimal(10,0)")).cast("int").alias("n"), F.col("a"))
    kept = firsts.join(gone, ["a", "b"], "left_anti").select(doc.cast("long").alias("__doc"), place.alias("p")).groupBy("__doc").agg(F.sort_array(F.collect_list("p")).alias("__kept"))
    # by line number the hash of the line that is kept there, so a line looks at one place; only rows that repeat a
    # doc_id can have several lines kept at one place, and search them all
    numbers = F.transform("__kept", lambda p: p["n"])
    before = lambda i: F.coalesce(F.get("__kept", i - 1)["n"], F.lit(-1))
    at = F.flatten(F.transform("__kept", lambda p, i: F.concat(F.array_repeat(F.lit(None).cast("long"), p["n"] - before(i) - 1), F.array(p["a"]))))
    once = F.size(F.array_distinct(numbers)) == F.size("__kept")
    kept = kept.select("__doc", F.when(once, at).alias("__at"), F.when(~once, F.col("__kept")).alias("__kept"))
    rows = docs.drop("lines_before", "lines_dropped").withColumn("__doc", F.col("doc_id").cast("long")).join(kept, "__doc", "left")
    lines = F.split(F.col("text").cast("string"), "\n", -1)
    same = lambda x, i: (F.get("__at", i) == F.xxhash64(x)) | F.array_contains(F.col("__kept"), F.struct(i.alias("n"), F.xxhash64(x).alias("a")))
    stays = lambda x, i: ~counts(x) | F.coalesce(same(x, i), F.lit(False))
    left = F.when(F.col("doc_id").isNull(), lines).otherwise(F.filter(lines, stays))
    rows = rows.withColumn("__left", left)
    none = F.col("text").isNull()
    rows = rows.withColumn("lines_before", F.when(none, 0).otherwise(F.size(lines))).withColumn("lines_dropped", F.when(none, 0).otherwise(F.size(lines) - F.size("__left")))
    return rows.withColumn("text", F.array_join("__left", "\n")).drop("__doc", "__at", "__kept", "__left")


#: The same rule over whole tables: halves that near lines share, then each pair of lines that meet by one.
ORACLE_SQL = """
WITH parts AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
 lines AS (SELECT doc_id, i - 1 AS line_no, ls[i] AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM parts)),
 part AS (SELECT * FROM lines WHERE length(trim(line, ' ')) >= 16),
 firsts AS (SELECT line, min((doc_id, line_no)) AS pos FROM part GROUP BY line),
 halves AS (SELECT line, pos, m, k, CASE WHEN k = 0 THEN right(line, m - m // 2) ELSE left(line, m // 2) END AS half
            FROM (SELECT line, pos, length(line) - d AS m, k FROM firsts, (VALUES (0), (1)) AS t(d), (VALUES (0), (1)) AS u(k))),
 pairs AS (SELECT DISTINCT a.line AS x, b.line AS y FROM halves a JOIN halves b ON a.m = b.m AND a.k = b.k AND a.half = b.half AND a.pos < b.pos),
 near AS (SELECT DISTINCT y FROM pairs WHERE CASE
            WHEN length(x) = length(y) THEN len(list_filter(range(1, length(x) + 1), lambda i: left(x, i - 1) || substr(x, i + 1) = left(y, i - 1) || substr(y, i + 1))) > 0
            WHEN length(x) = length(y) + 1 THEN len(list_filter(range(1, length(x) + 1), lambda i: left(x, i - 1) || substr(x, i + 1) = y)) > 0
            WHEN length(y) = length(x) + 1 THEN len(list_filter(range(1, length(y) + 1), lambda i: left(y, i - 1) || substr(y, i + 1) = x)) > 0
            ELSE false END),
 kept AS (SELECT l.doc_id, l.line_no, l.line FROM lines l LEFT JOIN firsts f ON l.line = f.line LEFT JOIN near n ON l.line = n.y
          WHERE f.line IS NULL OR (f.pos = (l.doc_id, l.line_no) AND n.y IS NULL)),
 texts AS (SELECT doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY line_no) AS text FROM kept GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END AS lines_before,
       CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) - coalesce(t.n, 0) END AS lines_dropped,
       md5(CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(t.text, '') END) AS text_md5
FROM documents d LEFT JOIN texts t ON d.doc_id = t.doc_id
"""
