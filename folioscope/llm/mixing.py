r"""Mixing sources to target weights by Pareto order sampling.

Targets: the mix has 150 % of all words; sources, by code point with null last, weigh 3, 1, 2, repeating; a target stops
at twice its source's size and the excess is shared again by weight until none is above (water filling: one level
lambda, target = min(cap, weight * lambda)).

Sampling: a document's expected number of copies is min(2, lambda * w), w its weight and lambda such that the source's
words come to its target. w is the integer root of the document's size, or any whole number given as ``weight``, so that
documents of one source have unequal odds. The whole part of the expectation is allocated as certain copies; the rest is
an inclusion probability p, and documents are taken in ascending order of the Pareto ranking variable
[u / (1 - u)] / [p / (1 - p)], u uniform by a hash of doc_id, up to the place where the source's words come nearest to
what its target still needs. The sample's size, in words, is thus fixed, and a document's chance is close to p.

No source is ever sorted: lambda comes from sums by (source, weight), and two histograms of the order, 4,096 bins each,
narrow the place of the cut down to 2^-24 of a source. Sources are numbered and their water level is found from range
partitions, so there may be as many sources as documents. All sums are of whole numbers: reruns agree to the bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import scan, skew

WEIGHTS = (3, 1, 2)
BINS = 4096
MOST = 2  # copies of a document
#: Per-source tables are broadcast up to this many sources (about 200 bytes each); beyond it, joins shuffle.
MOST_SOURCES = 200_000


def size_of(text: Column) -> Column:
    r"""Number of ``[^\x20\x09-\x0D]+`` in a text; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def source_key(source: Column) -> Column:
    """The source as a key that is never null."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source))


def uniform(doc_id: Column) -> Column:
    """A number in (0, 1) from the md5 of doc_id."""
    digest = F.md5(F.concat(F.lit("mix:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def order_key(u: Column, p: Column) -> Column:
    """The Pareto ranking variable q = [u/(1-u)] / [p/(1-p)], mapped to q/(1+q) in (0, 1)."""
    q = (u / (1 - u)) * ((1 - p) / p)
    return q / (1 + q)


def weight_of(size: Column) -> Column:
    """The default weight: the integer part of the root of the size."""
    return F.floor(F.sqrt(size.cast("double"))).cast("bigint")


def _before(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Adds, for each name, the sum of its expression over all rows before, in a total order; rows are range-partitioned."""
    ranged = scan.checkpointed(df.repartitionByRange(*order).withColumn("_at", F.spark_partition_id()))
    rows = Window.partitionBy("_at").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("_at").agg(*(F.sum(c).alias(f"_{n}") for n, c in sums.items()))  # one row per partition
    earlier = Window.partitionBy(F.lit(0)).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("_at"), *(F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}") for n in sums))
    local = ranged.select("*", *(F.coalesce(F.sum(c).over(rows), F.lit(0)).alias(n) for n, c in sums.items()))
    out = local.join(F.broadcast(parts), "_at")
    return out.select(*df.columns, *((F.col(n) + F.col(f"_{n}")).cast("bigint").alias(n) for n in sums))


def targets(sizes: DataFrame, percent: int = 150, weights: tuple[int, ...] = WEIGHTS, most_copies: int = MOST) -> DataFrame:
    """``sizes`` (source, sk, source_size: one row per source) with its target."""
    n, total = sizes.agg(F.count("*"), F.coalesce(F.sum("source_size"), F.lit(0))).first()
    all_weights = n // len(weights) * sum(weights) + sum(weights[: n % len(weights)])
    numbered = _before(sizes, [F.col("source").asc_nulls_last()], {"nth": F.lit(1)})
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("nth") % len(weights) + 1).cast("int"))
    out = numbered.withColumn("w", weight.cast("bigint")).withColumn("cap", F.col("source_size") * most_copies).withColumn("ratio", F.col("cap") / F.col("w"))
    out = scan.checkpointed(_before(out, [F.col("ratio"), F.col("source").asc_nulls_last()], {"full": F.col("cap"), "used": F.col("w")}))
    level = (F.lit(float(total * percent) / 100) - F.col("full")) / (F.lit(all_weights) - F.col("used"))
    first = out.withColumn("level", level).where("level <= ratio").agg(F.min_by("level", F.struct("ratio", F.col("source").isNull(), "source"))).first()[0]
    cap = F.col("cap").cast("double")
    return out.select(*sizes.columns, (cap if first is None else F.least(cap, F.col("w") * F.lit(first))).alias("target"))


def _attach(rows: DataFrame, table: DataFrame, sources: int, total: int) -> DataFrame:
    """Joins the row of each source: broadcast up to MOST_SOURCES, else by a shuffle that splits hot sources off."""
    return rows.join(F.broadcast(table), "sk") if sources <= MOST_SOURCES else skew.lookup(rows, table, ["sk"], "n_docs", total)


def expected(weight: Column, lam: Column) -> Column:
    """Expected copies; without a lambda every document with a weight is at the most."""
    return F.when(weight > 0, F.least(F.lit(float(MOST)), lam * weight)).otherwise(0.0)


def plan(docs: DataFrame, percent: int = 150, weights: tuple[int, ...] = WEIGHTS, weight: Column | None = None) -> tuple[DataFrame, DataFrame, int, int]:
    """(sized, cuts, sources, documents): documents' sizes and weights, and each source's target, lambda and place of the cut."""
    source, size = F.col("source").cast("string"), size_of(F.col("text").cast("string"))
    own = weight_of(F.col("size")) if weight is None else F.coalesce(F.greatest(F.col("w").cast("bigint"), F.lit(0)), F.lit(0))
    sized = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), source.alias("source"), source_key(source).alias("sk"), size.alias("size"), (F.lit(0) if weight is None else weight).alias("w"))
    sized = scan.checkpointed(sized.withColumn("w", own))
    # one row per source and weight: as many weights as there are roots of sizes, whatever the number of documents
    bins = scan.checkpointed(sized.groupBy("sk", "w").agg(F.first("source").alias("source"), F.sum("size").alias("words"), F.count("*").alias("n_docs")))
    sizes = bins.groupBy("sk").agg(F.first("source").alias("source"), F.sum("words").alias("source_size"), F.sum("n_docs").alias("n_docs"))
    goal = scan.checkpointed(targets(scan.checkpointed(sizes), percent, weights))
    n, total = goal.agg(F.count("*"), F.coalesce(F.sum("n_docs"), F.lit(0))).first()
    # water filling within the source: from the greatest weight on, documents are at the most, until lambda * w is below it
    mass = F.col("words").cast("decimal(20,0)") * F.col("w").cast("decimal(17,0)")
    down = Window.partitionBy("sk").orderBy(F.desc("w"))
    full = F.coalesce(F.sum("words").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("double")
    rest = F.sum(mass.cast("decimal(38,0)")).over(down.rowsBetween(0, Window.unboundedFollowing)).cast("double")
    side = goal.select("sk", "target")
    few = n <= MOST_SOURCES
    tried = bins.where("w > 0").join(F.broadcast(side) if few else side, "sk").withColumn("lam", (F.col("target") - MOST * full) / rest)
    lam = tried.where(F.col("lam") * F.col("w") < MOST).groupBy("sk").agg(F.max_by("lam", "w").alias("lam"))
    goal = goal.join(lam, "sk", "left")
    e = expected(F.col("w"), F.col("lam"))
    taken = bins.select("sk", "w", "words").join(goal.select("sk", "lam"), "sk").groupBy("sk").agg(F.sum(F.col("words") * F.floor(e)).alias("certain"))
    goal = goal.join(taken, "sk", "left").withColumn("need", F.col("target") - F.coalesce("certain", F.lit(0)))
    goal = scan.checkpointed(goal.drop("certain"))
    drawn = _attach(sized, goal.select("sk", "lam", "need", "n_docs"), n, total).withColumn("p", e - F.floor(e)).where("p > 0")
    drawn = drawn.withColumn("k", F.when(F.col("p") > 0, order_key(uniform(F.col("doc_id")), F.col("p")))).select("sk", "doc_id", "size", "need", "k")

    def narrow(rows: DataFrame, bins: Column) -> DataFrame:
        """Keeps each source's bin in which its need is reached, and subtracts the words of the bins before."""
        binned = rows.withColumn("bin", bins)
        counts = binned.groupBy("sk", "bin").agg(F.sum("size").alias("words"), F.first("need").alias("need"))
        upto = F.sum("words").over(Window.partitionBy("sk").orderBy("bin"))
        at = counts.withColumn("upto", upto).where("upto >= need").groupBy("sk").agg(F.min_by(F.struct("bin", (F.col("need") - F.col("upto") + F.col("words")).alias("need")), "bin").alias("at"))
        at = at.select("sk", F.col("at.bin").alias("bin"), F.col("at.need").alias("need"))
        return binned.drop("need").join(F.broadcast(at) if few else at, ["sk", "bin"]).drop("bin")

    one = F.floor(F.col("k") * BINS)
    two = F.floor((F.col("k") * BINS - one) * BINS)
    last = narrow(narrow(drawn, one), two)
    upto = F.sum("size").over(Window.partitionBy("sk").orderBy("k", "doc_id", "size"))
    # the last place not above the need, or the first above it, whichever is nearer; ties share a place
    place = F.struct(F.abs(F.col("need") - F.col("upto")).alias("off"), F.col("upto"))
    cut = last.withColumn("upto", upto).groupBy("sk").agg(
        F.min_by(F.struct("k", "doc_id", "size", "upto"), place).alias("at"), F.first("need").alias("need"),
        F.min(F.struct("k", "doc_id", "size")).alias("first"),
    )
    nearest = F.abs(F.col("need") - F.col("at.upto")) < F.col("need")  # else the place before this bin is nearer
    cut = cut.select("sk", F.when(nearest, F.struct("at.k", "at.doc_id", "at.size")).alias("last"), F.col("first"))
    return sized, scan.checkpointed(goal.join(cut, "sk", "left")), n, total


def copies(doc_id: Column, size: Column, weight: Column) -> Column:
    """Copies of a document, from its source's row of ``plan``."""
    e = expected(weight, F.col("lam"))
    p = e - F.floor(e)
    k = F.when(p > 0, order_key(uniform(doc_id), p))  # no division by an odds of 0
    key = F.struct(k.alias("k"), doc_id.cast("bigint").alias("doc_id"), size.alias("size"))
    # without a cut, rounding has left the need just above all drawn documents
    last, first = F.col("last"), F.col("first")
    upto = F.when(last.isNotNull(), key <= last).when(first.isNotNull(), key < first).otherwise(F.col("need") > 0)
    return F.floor(e) + F.when((p > 0) & F.coalesce(upto, F.lit(False)), 1).otherwise(0)


def mix(docs: DataFrame, percent: int = 150, weights: tuple[int, ...] = WEIGHTS, weight: Column | None = None) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken (words the mix takes of it).

    ``weight``: a whole number per document; null or negative is 0, and what weighs 0 is never taken. Null or empty text:
    size 0, taken 0. Null source: a source of its own, after all others. Sources without words have target 0. Repeated rows
    share one hash and are taken or left together. Extra columns are dropped. An empty table gives an empty mix.
    """
    sized, cuts, n, total = plan(docs, percent, weights, weight)
    rows = _attach(sized, cuts.drop("source"), n, total)
    return rows.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * copies(F.col("doc_id"), F.col("size"), F.col("w"))).cast("bigint").alias("taken"))


def mixed_documents(docs: DataFrame, percent: int = 150, weights: tuple[int, ...] = WEIGHTS, weight: Column | None = None) -> DataFrame:
    """The rows of ``docs``, all columns kept, each as often as the mix takes it. Texts are not shuffled.

    Rows of texts without words are never taken; otherwise as ``mix``.
    """
    _, cuts, n, total = plan(docs, percent, weights, weight)
    own = docs.columns
    size = size_of(F.col("text").cast("string"))
    mine = weight_of(size) if weight is None else F.coalesce(F.greatest(weight.cast("bigint"), F.lit(0)), F.lit(0))
    # all that the plan adds stands in one struct, so that no column of the documents can clash with it
    rows = docs.select(F.struct(*own).alias("row"), source_key(F.col("source").cast("string")).alias("sk"), F.col("doc_id").alias("doc_id"), size.alias("size"), mine.alias("w"))
    rows = _attach(rows, cuts.select("sk", "n_docs", "lam", "need", "last", "first"), n, total)
    rows = rows.select("row", copies(F.col("doc_id"), F.col("size"), F.col("w")).cast("int").alias("times")).where("times > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    floor(sqrt(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::DOUBLE))::BIGINT AS w FROM documents
), sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighted AS (
  SELECT *, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w, (source_size * 2)::DOUBLE AS cap FROM sizes
), levels AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE * 150 / 100 - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
    row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS place FROM weighted
), goal AS (
  SELECT source, source_size, coalesce(least(cap, w * (SELECT arg_min(level, place) FROM levels WHERE level <= cap / w)), cap) AS target FROM levels
), bins AS (
  SELECT source, w, sum(size) AS words FROM sized WHERE w > 0 GROUP BY source, w
), levels_within AS (
  SELECT b.source, b.w, (g.target - 2 * coalesce(sum(words) OVER (PARTITION BY b.source ORDER BY b.w DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / (sum(words * b.w) OVER (PARTITION BY b.source ORDER BY b.w DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS lam
  FROM bins b JOIN goal g ON b.source IS NOT DISTINCT FROM g.source
), lams AS (
  SELECT source, arg_max(lam, w) AS lam FROM levels_within WHERE lam * w < 2 GROUP BY source
), expected AS (
  SELECT d.*, g.source_size, g.target, CASE WHEN d.w > 0 THEN least(2.0::DOUBLE, coalesce(l.lam * d.w, 2.0)) ELSE 0.0 END AS e
  FROM sized d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source LEFT JOIN lams l ON d.source IS NOT DISTINCT FROM l.source
), drawn AS (
  SELECT *, floor(e) AS whole, e - floor(e) AS p, target - sum(size * floor(e)) OVER (PARTITION BY source) AS need,
    (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM expected
), keyed AS (
  SELECT *, CASE WHEN p > 0 THEN ((u / (1 - u)) * ((1 - p) / p)) / (1 + (u / (1 - u)) * ((1 - p) / p)) END AS k FROM drawn
), run AS (
  SELECT *, CASE WHEN p > 0 THEN sum(size) OVER (PARTITION BY source, p > 0 ORDER BY k, doc_id NULLS FIRST, size) END AS upto FROM keyed
), cut AS (
  SELECT source, min(abs(need - upto)) AS off FROM run WHERE p > 0 GROUP BY source
), best AS (
  SELECT r.source, min(r.upto) AS upto, any_value(c.off) AS off FROM run r JOIN cut c ON r.source IS NOT DISTINCT FROM c.source AND abs(r.need - r.upto) = c.off WHERE r.p > 0 GROUP BY r.source
)
SELECT r.doc_id, r.source, r.size, r.source_size, r.target,
  (r.size * (r.whole + CASE WHEN r.p > 0 AND b.off < r.need AND r.upto <= b.upto THEN 1 ELSE 0 END))::BIGINT AS taken
FROM run r LEFT JOIN best b ON r.source IS NOT DISTINCT FROM b.source
"""
