r"""MinHash near-dedup with fast similarity sketching.

Sets are the distinct 3-word shingles of a text, A-Z lower-cased, words ``[^\x20\x09-\x0D]+``. Sketch: in round i
every element is hashed to a random bin (rounds 0 to t-1) or all to bin i - t (rounds t to 2t-1); a bin keeps the
least value of the first round that reached it, so every coordinate fills and two sets agree in one with
probability equal to their similarity. Bands of coordinates give candidate buckets.

Plan: (1) equal sets collapse to one class; (2) each class is linked to the least member of each of its buckets,
confirmed on the full sets; (3) components of these stars; (4) in buckets that still hold several components,
members outside the first component are the queries, compared with all members in blocks of bounded size; pairs of
one component need no comparison; (5) components of all links. No pair list of a bucket is made, no bucket is
capped, and a hot bucket costs linear work once its stars have joined it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scan, skew

BANDS, ROWS = 20, 4
T = BANDS * ROWS
BLOCK_ROWS, BLOCK_SHINGLES = 1024, 500_000
_U = np.uint64
_A, _B = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9)
_SEEDS = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 64, 2 * T, dtype=np.uint64)


def shingles(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted by (text, hash); the text of each; bounds per text."""
    starts, ends, bounds = scan.words(data, offs, scan.NONSPACE)
    h = scan.span_hash(scan.prefix_sums(data, scan.FOLD), starts, ends)
    text = scan.owner(bounds)
    one, two = np.append(h[1:], _U(0))[: len(h)], np.append(h[2:], [_U(0), _U(0)])[: len(h)]
    left = bounds[1:][text] - np.arange(len(h))  # words from here to the text's end
    n = np.diff(bounds)[text]
    # a text of fewer than three words has one shingle, all its words
    use = (left >= 3) | ((n < 3) & (left == n))
    one, two = np.where(left >= 2, one, _U(1)), np.where(left >= 3, two, _U(2))
    s = scan.mix(scan.mix(scan.mix(h) * _A + one) * _B + two)[use]
    text = text[use]
    by = np.lexsort((s, text))
    s, text = s[by], text[by]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (text[1:] != text[:-1])
    s, text = s[new], text[new]
    return s, text, np.searchsorted(text, np.arange(len(offs)))


def sketch(s: np.ndarray, text: np.ndarray, rows: int, t: int = T) -> np.ndarray:
    """Sketches (rows x t) of the sets; a row without elements stays at the largest value."""
    top = np.iinfo(np.uint64).max
    out = np.full(rows * t, top, np.uint64)
    have = np.zeros(rows, bool)
    have[text] = True
    for i in range(2 * t):
        g = scan.mix(s ^ _SEEDS[i % len(_SEEDS)] + _U(i))
        place = (((g >> _U(32)) * _U(t)) >> _U(32)).astype(np.int64) if i < t else np.full(len(s), i - t)
        slot = text * t + place
        if i:
            free = out[slot] == top
            slot, g = slot[free], g[free]
        np.minimum.at(out, slot, scan.mix(g + _A) >> _U(1))
        lacking = have & (out.reshape(rows, t) == top).any(axis=1)
        if not lacking.any():
            break
        keep = lacking[text]
        s, text = s[keep], text[keep]
    return out.reshape(rows, t)


def band_keys(sketches: np.ndarray) -> np.ndarray:
    key = np.zeros((len(sketches), BANDS), np.uint64)
    part = sketches.reshape(len(sketches), BANDS, ROWS)
    for r in range(ROWS):
        key = scan.mix(key * _A + part[:, :, r])
    return scan.mix(key + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def _signatures(docs: DataFrame) -> DataFrame:
    names = ["doc_id", "h", "n", "d1", "d2", "bands"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column(2)
        parts = []
        for lo, hi in scan.slices(column):
            s, text, bounds = shingles(*scan.texts(column, lo, hi))
            sums = [np.zeros(len(s) + 1, np.uint64) for _ in range(2)]
            for x, seed in zip(sums, (_A, _B)):
                np.cumsum(scan.mix(s + seed), out=x[1:])
            digest = [(x[bounds[1:]] - x[bounds[:-1]]).view(np.int64) for x in sums]
            parts.append((np.diff(bounds), *digest, band_keys(sketch(s, text, hi - lo))))
        n, d1, d2, keys = (np.concatenate(x) for x in zip(*parts))
        bands = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32)), pa.array(keys.ravel()))
        return pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(n), pa.array(d1), pa.array(d2), bands], names=names)

    return scan.map_arrow(docs.select("doc_id", F.xxhash64("text").alias("h"), "text"), run, "doc_id long, h long, n long, d1 long, d2 long, bands array<long>")


def similar(a: pa.Array, b: pa.Array, percent: int) -> np.ndarray:
    """Whether each row's two texts reach the similarity, on full sets. Rows are taken in slices of about 1 MB of text."""
    out = []
    n = len(a)
    ends = scan.texts(a)[1] + scan.texts(b)[1]
    lo = 0
    while lo < n:
        hi = min(n, max(int(np.searchsorted(ends, ends[lo] + (1 << 20), "right")) - 1, lo + 1))
        sets = [shingles(*scan.texts(x, lo, hi)) for x in (a, b)]
        s, row = np.concatenate([x[0] for x in sets]), np.concatenate([x[1] for x in sets])
        key = np.lexsort((s, row))
        s, row = s[key], row[key]
        common = np.bincount(row[1:][(s[1:] == s[:-1]) & (row[1:] == row[:-1])], minlength=hi - lo)
        size = sum(np.diff(x[2]) for x in sets)
        out.append((100 * common >= percent * (size - common)) & (common > 0))
        lo = hi
    return np.concatenate(out) if out else np.zeros(0, bool)


def _find(parent: dict, x: int) -> int:
    while (p := parent.setdefault(x, x)) != x:
        parent[x] = parent.setdefault(p, p)
        x = parent[x]
    return x


def _unit_links(unit: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Links between components among one block of queries and one block of members."""
    rep, comp = unit["rep"].to_numpy(), unit["comp"].to_numpy()
    query, n, band = unit["query"].to_numpy(), unit["n"].to_numpy(), int(unit["b"][0].as_py())
    keys = np.asarray(unit["bands"].combine_chunks().flatten()).reshape(-1, BANDS)
    s, text, bounds = shingles(*scan.texts(unit["text"].combine_chunks()))
    values, code = np.unique(s, return_inverse=True)
    member = np.flatnonzero(query == 0)
    mine = np.isin(text, member)
    by = np.argsort(code[mine], kind="stable")
    posting, begin = text[mine][by], np.searchsorted(code[mine][by], np.arange(len(values) + 1))
    parent: dict[int, int] = {}
    links = []
    for q in np.flatnonzero(query == 1):
        ok = member[(comp[member] != comp[q]) & (100 * np.minimum(n[member], n[q]) >= percent * np.maximum(n[member], n[q]))]
        if len(ok) and band:  # a pair is compared in the first bucket that it shares
            ok = ok[~(keys[ok, :band] == keys[q, :band]).any(axis=1)]
        if not len(ok):
            continue
        c = code[bounds[q] : bounds[q + 1]]
        size = begin[c + 1] - begin[c]
        at = np.repeat(begin[c], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        common = np.bincount(posting[at], minlength=len(rep))[ok]
        for m in ok[100 * common >= percent * (n[ok] + n[q] - common)]:
            x, y = _find(parent, int(comp[q])), _find(parent, int(comp[m]))
            if x != y:
                parent[x] = y
                links.append((int(comp[q]), int(comp[m])))
    return links


def _residual(units: DataFrame, percent: int) -> DataFrame:
    """Runs the units, which lie together and in order within each partition; holds one unit at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None

        def flush() -> Iterator[pa.RecordBatch]:
            if held and (links := _unit_links(pa.Table.from_batches(held), percent)):
                yield pa.RecordBatch.from_pydict({"a": [x for x, _ in links], "b": [y for _, y in links]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

        for batch in batches:
            ids = np.stack([batch.column(k).to_numpy() for k in range(4)], axis=1)
            cuts = np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(ids)]):
                if lo == hi:
                    continue
                now = tuple(ids[lo])
                if now != key:
                    yield from flush()
                    held, key = [], now
                held.append(batch.slice(lo, hi - lo))
            scan.trim()
        yield from flush()

    scan.small_batches(units.sparkSession)
    return units.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Null or wordless texts have an empty set and stay alone. A null doc_id is never linked: its component is null and it is
    kept. Rows of one doc_id are one document: different texts of it take part each under an id made from the text
    (above 2^62), and all that any of them is linked with is linked with the document. Extra columns are dropped.
    """
    rows = docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text")
    sig = scan.checkpointed(_signatures(rows))
    total = sig.count()
    many = sig.where("doc_id is not null and n > 0").groupBy("doc_id").agg(F.min("h").alias("lo"), F.max("h").alias("hi"))
    many = scan.checkpointed(many.where("lo <> hi").select("doc_id", F.lit(True).alias("many")))
    n_many = many.count()
    own = sig.select("doc_id", F.col("doc_id").alias("own"), "h", "n", "d1", "d2", "bands")
    aliases = None
    if n_many:  # rare; the texts' rows are given ids of their own
        made = lambda many: F.when(many, F.shiftrightunsigned(F.xxhash64("h", "own"), 2).bitwiseOR(F.lit(1 << 62))).otherwise(F.col("doc_id"))
        side = F.broadcast(many) if n_many <= skew.MOST_IDS else many
        own = scan.checkpointed(own.join(side, "doc_id", "left").withColumn("doc_id", made(F.col("many") & (F.col("n") > 0))).drop("many"))
        aliases = own.where("doc_id <> own").select(F.col("doc_id").alias("a"), F.col("own").alias("b")).distinct()
        rows = rows.withColumn("own", F.col("doc_id")).withColumn("h", F.xxhash64("text")).join(side, "doc_id", "left").select(made(F.col("many")).alias("doc_id"), "text")
    sig = own
    full = sig.where("n > 0 and doc_id is not null")
    classes = full.groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    member = skew.lookup(full.select("doc_id", "n", "d1", "d2"), classes, ["n", "d1", "d2"], "copies", total)
    member = scan.checkpointed(member.select("doc_id", "n", "rep"))
    alike = member.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    # one row per class and band; a class is named by its least document
    reps = class_rows(full, member)
    band = reps.select(F.col("doc_id").alias("rep"), "n", F.posexplode("bands").alias("b", "key"))
    bucket = scan.checkpointed(
        band.groupBy("b", "key")
        .agg(F.min("rep").alias("center"), F.min_by("n", "rep").alias("center_n"), F.count("*").alias("c"), F.sum("n").alias("weight"))
        .where("c > 1 and center is not null")
    )
    in_bucket = scan.checkpointed(
        skew.lookup(band.select("b", "key", "rep", "n"), bucket, ["b", "key"], "c", total).where("center is not null")
    )
    star = in_bucket.where(f"rep <> center and 100 * least(n, center_n) >= {percent} * greatest(n, center_n)")
    star = scan.checkpointed(star.select("rep", "center").distinct())
    ids = scan.checkpointed(in_bucket.select(F.col("rep").alias("doc_id")).distinct())
    n_ids = ids.count()
    kept_text = skew.by_ids(rows, "doc_id", ids, n_ids, "left_semi").dropDuplicates(["doc_id"])
    kept_text = scan.checkpointed(kept_text.join(reps.select("doc_id", "bands"), "doc_id"))

    # confirm the stars; a center with many members is salted
    pairs = star.count()
    hot = star.groupBy("center").count().where(F.col("count") * skew.HOT > max(pairs, skew.HOT * 64)).select("center", F.lit(64).alias("salts"))
    hot = F.broadcast(hot)
    left = star.join(hot, "center", "left").withColumn("salt", F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64("rep"), F.lit(64))).cast("int"))
    left = left.drop("salts").join(kept_text.select(F.col("doc_id").alias("rep"), F.col("text").alias("t1")), "rep")
    right = kept_text.select(F.col("doc_id").alias("center"), F.col("text").alias("t2")).join(hot, "center", "left")
    right = right.withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("salts"), F.lit(1)) - 1))).drop("salts")

    def confirm(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.select(["a", "b"]).filter(pa.array(similar(batch.column(2), batch.column(3), percent)))

    joined = left.join(right, ["center", "salt"]).select(F.col("rep").alias("a"), F.col("center").alias("b"), "t1", "t2")
    links = scan.checkpointed(scan.map_arrow(joined, confirm, "a long, b long"))
    first = scan.checkpointed(skew.components(links))

    # buckets of three or more that hold several components
    placed = in_bucket.where("c > 2").join(first, F.col("rep") == F.col("node"), "left").withColumn("comp", F.coalesce("comp", "rep")).drop("node")
    placed = scan.checkpointed(placed.select("b", "key", "rep", "n", "comp", "center", "c", "weight"))
    home = placed.groupBy("b", "key").agg(
        F.first("c").alias("home_c"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max(F.when(F.col("rep") == F.col("center"), F.col("comp"))).alias("home")
    ).where("lo <> hi").select("b", "key", "home", "home_c")
    mixed = skew.lookup(placed, scan.checkpointed(home), ["b", "key"], "home_c", total).where("home is not null").drop("home_c")
    queries = mixed.where("comp <> home")
    count = queries.groupBy("b", "key").agg(F.count("*").alias("qc"), F.sum("n").alias("qw"), F.first("c").alias("count_c"))
    blocks = lambda c, w: F.ceil(F.greatest(F.col(c) / BLOCK_ROWS, F.col(w) / BLOCK_SHINGLES)).cast("int")
    sized = scan.checkpointed(skew.lookup(mixed, count, ["b", "key"], "count_c", total).drop("count_c").withColumn("mb", blocks("c", "weight")).withColumn("qb", blocks("qc", "qw")).withColumn("query", (F.col("comp") != F.col("home")).cast("int")))
    own = lambda k: F.pmod(F.xxhash64("rep"), F.col(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    cols = ["b", "key", "i", "j", "rep", "comp", "n"]
    as_member = sized.withColumn("j", own("mb")).withColumn("i", every("qb")).select(*cols, F.lit(0).alias("query"))
    as_query = sized.where("query = 1").withColumn("i", own("qb")).withColumn("j", every("mb")).select(*cols, F.lit(1).alias("query"))
    unit = as_member.unionByName(as_query).join(kept_text.withColumnRenamed("doc_id", "rep"), "rep")
    unit = unit.select(*cols, "query", "bands", "text").repartition("b", "key", "i", "j").sortWithinPartitions("b", "key", "i", "j")
    late = _residual(unit, percent)
    tops = first.selectExpr("node a", "comp b")
    every_link = tops.unionByName(late).unionByName(alike)
    final = skew.components(scan.checkpointed(every_link if aliases is None else every_link.unionByName(aliases)))
    return _result(sig, final)


def class_rows(full: DataFrame, member: DataFrame) -> DataFrame:
    """The signature row of each class: rows whose document is its class's least."""
    own = member.where("doc_id = rep").select("doc_id").distinct()
    return full.join(own, "doc_id", "left_semi").dropDuplicates(["doc_id", "n"])


def _result(sig: DataFrame, final: DataFrame) -> DataFrame:
    out = sig.select(F.col("own").alias("doc_id"), F.col("n").alias("n_shingles")).join(final, F.col("doc_id") == F.col("node"), "left")
    comp = F.coalesce("comp", "doc_id")
    return out.select("doc_id", "n_shingles", comp.alias("component_id"), F.coalesce(comp == F.col("doc_id"), F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, percent: int = 85) -> DataFrame:
    """The rows of ``docs``, all columns kept, whose document is its component's least; of its equal rows, one.

    Rows without doc_id take part under an id made from their text, above 2^62, so that others go first. Texts of one
    doc_id are equal if they differ in case and white space only. Rows without words are no copies and stay.
    """
    key, same = (next(c for k in range(len(docs.columns) + 1) if (c := f"{name}_{k}") not in docs.columns) for name in ("__id", "__same"))
    words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    made = F.shiftrightunsigned(F.xxhash64("text"), 2).bitwiseOR(F.lit(1 << 62))
    rows = docs.withColumn(key, F.coalesce(F.col("doc_id").cast("bigint"), F.when(words, made)))
    near = scan.checkpointed(near_duplicates(rows.select(F.col(key).alias("doc_id"), "text"), percent).select(F.col("doc_id").alias(key), "kept"))
    gone = near.where("not kept").select(key).distinct()
    left = skew.by_ids(rows, key, gone, gone.count(), "left_anti")
    again = scan.checkpointed(near.where(F.col("kept") & F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(same)).where(F.col(same) > 1).select(key))
    if n := again.count():
        twice = skew.by_ids(left, key, again, n, "left_semi")
        folded = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        folded = F.trim(F.regexp_replace(folded, r"[\x20\x09-\x0D]+", " "))
        one = twice.where(words).withColumn(same, folded).dropDuplicates([key, same]).drop(same)
        left = skew.by_ids(left, key, again, n, "left_anti").unionByName(twice.where(~words)).unionByName(one)
    return left.select(*docs.columns)


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), sh AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 3 THEN [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d)
), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_ways AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT p.a, p.b FROM both_ways p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * p.c >= 85 * (x.n + y.n - p.c)
), reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, c.component_id = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
"""
