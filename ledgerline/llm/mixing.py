"""Mixing sources to target weights by capped water-filling, in DataFrame operations only.

Sources in code-point order (null last) weigh 5, 2, 1, repeating. Together they share ``budget`` times all
words. A source is clamped at ``max_epochs`` times its own words; the excess is shared among the others by
weight, again and again until none is above. A source whose target is e times its size takes each document
floor(e) times, and the documents that come first in a seeded order once more, up to the rest of the target.

The seeded order is that of a hash over id, size, text and, if there are any, the other columns, so rows that
share their place are equal. Where the rest of a target ends among equal rows, as many of them are taken as
nearest fit; these rows are counted and made again from one of them, so that no task has to number them.

Cases: null text counts 0 words; null source is a source; a source without words has target 0; repeated rows,
with or without an id, are taken one by one; ties in the order are equal rows; texts of any length count whole;
an empty table gives an empty mix. Extra columns pass through ``take`` untouched, whatever their names and types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, hashable, small, stage, word_count

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 20240
#: Equal rows that one task makes again.
CHUNK = 100_000


def _key(docs: DataFrame, seed: int):
    """A seeded place in the order of documents: 32 hex digits, more if there are columns beyond those of the digests."""
    text = F.coalesce(F.md5("text"), F.lit("null"))
    place = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit("|"), text))
    others = sorted(c for c in docs.columns if c not in ("doc_id", "text", "source"))
    return F.concat(place, F.lower(F.lpad(F.hex(F.xxhash64(*hashable(docs, others))), 16, "0"))) if others else place


def water_level(sources: DataFrame, total: float) -> float:
    """The level at which sources with ``weight`` and ``cap`` take ``total``: target = least(cap, level * weight).

    Each round is one aggregate over the sources; the set of clamped ones only grows."""
    level, clamped = 0.0, -1
    while True:
        over = F.col("cap") <= F.lit(level) * F.col("weight")
        n, used, free = sources.agg(F.count(F.when(over, 1)), F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0))).first()
        if n == clamped or not free:
            return level
        level, clamped = (total - used) / free, n


def source_plan(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, budget: float = 1.0, seed: int = SEED) -> DataFrame:
    """One row per source: source, source_size, target, whole (repetitions of each document), cut and at_cut (documents
    whose key is under ``cut`` are taken once more, and ``at_cut`` of those whose key is ``cut``)."""
    sized = stage(docs.select("source", word_count(F.col("text")).alias("size"), _key(docs, seed).alias("key")), "mix-sizes")
    # Ranks by ranges of sources, so that no task needs all of them.
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size")).repartitionByRange(8, F.col("source").asc_nulls_last())
    totals = stage(totals.withColumn("part", F.spark_partition_id()), "mix-sources")
    before, offset = F.lit(0), 0
    for part, n in sorted((r["part"], r["count"]) for r in totals.groupBy("part").count().collect()):
        before = F.when(F.col("part") == part, F.lit(offset)).otherwise(before)
        offset += n
    rank = before + F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    ranked = totals.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * max_epochs).alias("cap"))
    ranked = stage(ranked, "mix-weights")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level = water_level(ranked, total * budget)
    target = F.round(F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight")), 6)
    plan = ranked.select("source", "source_size", target.alias("target"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-12)).otherwise(0).cast("long")
    plan = plan.withColumn("whole", whole).withColumn("rest", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0)))
    return _with_cut(plan, sized)


def _with_cut(plan: DataFrame, sized: DataFrame) -> DataFrame:
    """Words by source and two digits of the key are summed before any ordering, then by two more digits within the
    range where the rest of a target ends; only there are documents ordered, so no task sees a source's documents."""
    edge = plan.where("rest > 0").select("source", "rest", F.lit("").alias("bucket"), F.lit(0).cast("long").alias("before"))
    for width in (2, 4):
        e, z = stage(edge, "mix-edges").alias("e"), sized.alias("z")
        inside = z.join(small(e), e["source"].eqNullSafe(z["source"]) & z["key"].startswith(e["bucket"]))
        sums = inside.groupBy(e["source"].alias("source"), "rest", "before", F.substring(z["key"], 1, width).alias("bucket")).agg(F.sum("size").alias("words"))
        order = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("before", F.col("before") + F.coalesce(F.sum("words").over(order), F.lit(0)))
        edge = sums.where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words"))).select("source", "rest", "bucket", "before")
    e, z = stage(edge, "mix-edges").alias("e"), sized.alias("z")
    inside = z.join(small(e), e["source"].eqNullSafe(z["source"]) & z["key"].startswith(e["bucket"]))
    keys = inside.groupBy(e["source"].alias("source"), "rest", "before", "bucket", "key", "size").agg(F.count("*").alias("n"))
    running = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    sofar = F.col("before") + F.coalesce(F.sum(F.col("size") * F.col("n")).over(running), F.lit(0))
    # Of n equal rows those are taken whose middle lies within the rest.
    fit = F.when(F.col("size") > 0, F.floor((F.col("rest") - F.col("sofar")) / F.col("size") + 0.5)).otherwise(F.when(F.col("sofar") <= F.col("rest"), F.col("n")).otherwise(0))
    keys = keys.withColumn("sofar", sofar).withColumn("fit", F.least(F.greatest(fit, F.lit(0)), "n").cast("long"))
    last = keys.groupBy("source", "bucket").agg(F.max(F.when(F.col("fit") > 0, F.struct("key", "fit"))).alias("last"))
    cuts = last.select(F.col("source").alias("cut_source"), F.coalesce(F.col("last.key"), F.col("bucket")).alias("cut"), F.coalesce(F.col("last.fit"), F.lit(0)).alias("at_cut"))
    joined = plan.join(small(stage(cuts, "mix-cuts")), F.col("source").eqNullSafe(F.col("cut_source")), "left")
    # No edge: nothing is left of the target, or (by rounding) all of the source is wanted once more.
    cut = F.coalesce("cut", F.when((F.col("rest") > 0) & (F.col("rest") >= F.col("source_size")), F.lit("g")).otherwise(F.lit("")))
    return stage(joined.select("source", "source_size", "target", "whole", cut.alias("cut"), F.coalesce("at_cut", F.lit(0)).cast("long").alias("at_cut")), "mix-plan")


def mix(docs: DataFrame, seed: int = SEED, **options) -> tuple[DataFrame, str]:
    """``docs`` with a struct column of size, source_size, target, copies, taken; and that column's name."""
    plan = source_plan(docs, seed=seed, **options)
    name = fresh(docs, "mix")
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), _key(docs, seed).alias("key"))
    joined = row.join(small(plan), F.col("row.source").eqNullSafe(F.col("source")), "left")
    clear = joined.where("key != cut").select("row", "source_size", "target", (F.col("whole") + (F.col("key") < F.col("cut")).cast("long")).alias("copies"))
    equal = joined.where("key = cut").groupBy("source", "key").agg(F.count("*").alias("n"), *(F.first(c).alias(c) for c in ("row", "source_size", "target", "whole", "at_cut")))
    equal = equal.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / CHUNK)))).repartition("key", "chunk")
    equal = equal.withColumn("i", F.explode(F.sequence(F.col("chunk") * CHUNK + 1, F.least("n", (F.col("chunk") + 1) * CHUNK))))
    equal = equal.select("row", "source_size", "target", (F.col("whole") + (F.col("i") <= F.col("at_cut")).cast("long")).alias("copies"))
    both = clear.unionByName(equal).withColumn("size", word_count(F.col("row.text")))
    struct = F.struct("size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))
    return both.select(*(F.col("row")[c].alias(c) for c in docs.columns), struct.alias(name)), name


def digests(docs: DataFrame) -> DataFrame:
    """One row per document: size, source_size, target, taken."""
    out, m = mix(docs.select("doc_id", "source", "text"))
    return out.select("doc_id", *(F.col(m)[c].alias(c) for c in ("size", "source_size", "target", "taken")))


def take(docs: DataFrame) -> DataFrame:
    """Each document as often as the mix takes it, with all its columns; those not taken go."""
    out, m = mix(docs)
    n = fresh(out, "copy")
    return out.where(F.col(m)["copies"] > 0).withColumn(n, F.explode(F.sequence(F.lit(1), F.col(m)["copies"]))).drop(m, n)


DIGEST_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, text, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, sum(size) AS source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM d GROUP BY source
), o AS (
  SELECT *, {MAX_EPOCHS} * source_size AS cap, row_number() OVER (ORDER BY CAST(source_size AS DOUBLE) / weight, source NULLS LAST) AS k FROM s
), c AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
    sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free, sum(source_size) OVER () AS total FROM o
), l AS (SELECT min_by(CAST(total - used AS DOUBLE) / free, k) AS level FROM c WHERE cap > CAST(total - used AS DOUBLE) / free * weight),
t AS (SELECT source, source_size, round(least(CAST(cap AS DOUBLE), level * weight), 6) AS target FROM o, l),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size + 1e-12) ELSE 0 END AS whole FROM t),
m AS (
  SELECT d.doc_id, size, source_size, target, whole, target - whole * source_size AS rest, md5('{SEED}|' || coalesce(CAST(d.doc_id AS VARCHAR), 'null') || '|' || coalesce(md5(d.text), 'null')) AS key, d.source
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
), r AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sofar FROM m)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target, CAST(size * (whole + CASE WHEN rest > 0 AND sofar + size / 2.0 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM r
"""
