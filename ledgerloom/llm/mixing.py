"""Mixing sources to target weights by capped water-filling, in DataFrame operations only.

Every source asks for a share of the budget in proportion to its weight and can give at most `max_epochs` times
its own size. With the sources in ascending order of capacity over weight, those that are clamped are a prefix
of that order, so the fixpoint of "clamp, reshare the excess by weight, repeat" is found with running sums over
the aggregated sources (one row per source; documents are never gathered).

A source that must give e epochs takes each document floor(e) times, and once more the documents that come
first in a seeded order until the source's target is met as closely as whole documents can. The order is cut in
two steps: sums over hash buckets find the bucket in which the target falls, and only the documents of that
bucket are ordered.

Null texts have size 0, null sources are a source of their own and come last. Rows without an id are ordered by their
text instead. Rows with equal id and text are interchangeable; each row is mixed by itself. An empty table gives an empty result. Sizes of zero take nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._base import written

WEIGHTS = (5, 2, 1)
SEED = "mix-1"
#: Hex digits of the seeded hash that name a bucket: 16**BUCKET_DIGITS buckets in a source.
BUCKET_DIGITS = 4
#: Sources up to this number are broadcast (some 20 MB); more are joined by shuffling, where Spark splits skewed ones.
BROADCAST_SOURCES = 200_000


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def source_targets(sizes: DataFrame, *, weights: Sequence[float], share: float, max_epochs: float) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size), one row per source.

    Sources take the weights in code point order, null last, over and over.
    """
    everyone = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(everyone) - 1) % len(weights) + 1).cast("int"))
    asked = sizes.withColumn("weight", w).withColumn("cap", F.col("source_size") * float(max_epochs))
    by_need = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before, total = by_need.rowsBetween(Window.unboundedPreceding, -1), by_need.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (float(share) * F.sum("source_size").over(total) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("weight").over(total) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    # from the first source that the level leaves room for, all share one level
    first = asked.withColumn("level", level).withColumn("open", F.col("level") * F.col("weight") <= F.col("cap"))
    shared = F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), F.coalesce(F.col("source").isNull().cast("int"), F.lit(0)), "source", "level"))).over(total)["level"]
    target = F.when(shared.isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), shared * F.col("weight")))
    return first.withColumn("target", target).select("source", "source_size", "weight", "target")


def mix_sources(docs: DataFrame, *, weights: Sequence[float] = WEIGHTS, share: float = 1.5, max_epochs: float = 2.0, seed: str = SEED, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, source, size, source_size, target, epochs, repeats, taken) for each row of docs (doc_id, text, source).

    `repeats` is how often the mix takes the document, `taken` the words it takes so. Columns named in `keep`
    come along under their own names; they must differ from the names above.
    """
    id_ = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), id_).cast("binary"))
    rows = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), digest.alias("place"), *keep).withColumn("bucket", F.substring("place", 1, BUCKET_DIGITS))
    # words are counted once; only columns in `keep` are read again
    counted = written(rows.drop(*keep), "sizes")
    rows = rows if keep else counted
    buckets = counted.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    targets = source_targets(buckets.groupBy("source").agg(F.sum("words").alias("source_size")), weights=weights, share=share, max_epochs=max_epochs)
    size = F.col("source_size")
    plan = targets.withColumn("epochs", F.when(size > 0, F.floor(F.col("target") / size)).otherwise(F.lit(0)).cast("long")).withColumn("part", F.when(size > 0, F.col("target") - F.col("epochs") * size).otherwise(F.lit(0.0)))
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cuts = buckets.withColumn("before", F.coalesce(F.sum("words").over(upto), F.lit(0))).withColumnRenamed("source", "s")
    edges = plan.withColumnRenamed("source", "s2").join(cuts, F.col("s").eqNullSafe(F.col("s2"))).where((F.col("before") <= F.col("part")) & (F.col("part") < F.col("before") + F.col("words")))
    edges = edges.groupBy("s").agg(F.max(F.struct("bucket", "before")).alias("cut"))
    per_source = plan.join(edges, F.col("source").eqNullSafe(F.col("s")), "left").select(F.col("source").alias("of"), "source_size", "target", "epochs", "part", F.col("cut.bucket").alias("cut"), F.col("cut.before").alias("before"))
    # one row a source, so that neither a hot source nor the columns in `keep` are shuffled
    few = counted.select("source").distinct().limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    placed = rows.join(F.broadcast(per_source) if few else per_source, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    whole = placed.where("cut is null or bucket <> cut").withColumn("extra", F.coalesce(F.col("bucket") < F.col("cut"), F.lit(False)).cast("long"))
    ordered = Window.partitionBy("source").orderBy("place", "size").rowsBetween(Window.unboundedPreceding, -1)
    last = placed.where("bucket = cut").withColumn("upto", F.col("before") + F.coalesce(F.sum("size").over(ordered), F.lit(0)))
    # the document that crosses the target is taken if that comes nearer to it
    last = last.withColumn("extra", ((F.col("part") > 0) & (F.col("upto") + F.col("size") / 2 <= F.col("part"))).cast("long")).drop("upto")
    return whole.unionByName(last).withColumn("repeats", F.col("epochs") + F.col("extra")).select("doc_id", "source", "size", "source_size", "target", "epochs", "repeats", (F.col("size") * F.col("repeats")).alias("taken"), *keep)


ORACLE = r"""
WITH RECURSIVE rows_ AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'text ' || md5(coalesce(text, '')))) AS place
  FROM documents),
sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM rows_ GROUP BY source),
asked AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap,
         CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS weight
  FROM sizes),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER w, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
  FROM asked WINDOW w AS (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
shared AS (SELECT arg_min(level, cap / weight) AS level FROM levels WHERE level * weight <= cap),
targets AS (
  SELECT a.source, a.source_size, CASE WHEN s.level IS NULL THEN cap ELSE least(cap, s.level * weight) END AS target
  FROM asked a CROSS JOIN shared s),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs,
         CASE WHEN source_size > 0 THEN target - floor(target / source_size) * source_size ELSE 0 END AS part
  FROM targets),
ordered AS (
  SELECT r.*, p.source_size, p.target, p.epochs, p.part,
         coalesce(sum(r.size) OVER (PARTITION BY r.source ORDER BY r.place, r.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS upto
  FROM rows_ r JOIN plan p ON r.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, CAST(size * (epochs + CASE WHEN upto + size / 2 <= part THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM ordered
"""
