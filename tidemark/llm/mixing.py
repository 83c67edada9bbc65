"""Mixing sources to target weights.

Token counts are aggregated per source (partial aggregation, so a hot source is one row per task after it);
targets follow from the weights by water filling with a cap; each document is then emitted ``floor(rate)`` times plus
one Bernoulli copy whose probability is the rate's fraction, decided by a hash of ``doc_id`` and a seed. The decision
needs no order, state or second look at other rows, so reruns and lost executors cannot change it.

Defined results: null text has size 0; the null source is a source, last in order; null ``doc_id`` hashes as empty text;
repeated rows take the same decision each; a source without words has target 0; an empty table gives an empty result;
further columns are ignored by ``mixture_plan`` and kept by ``emit_copies``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import documents, free_names, text_of

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
#: Sources up to this number are broadcast; beyond it the plan joins by shuffle.
BROADCAST_SOURCES = 100_000


def word_count(name: str = "text"):
    return F.regexp_count(text_of(name), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size) to (source, source_size, target): weights by code point order, water filling up to the cap.

    A source stops at its cap exactly if cap / weight lies under the final level; sorting by that ratio, the level is
    (total - caps before) / (weights from here on) at the first ratio that reaches it. Windows run over sources only.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.withColumn("w", F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), ((F.row_number().over(order) - 1) % len(WEIGHTS) + 1).cast("int")).cast("long"))
    level = weighed.withColumn("cap", F.col("source_size") * CAP).withColumn("ratio", F.col("cap") / F.col("w"))
    by = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    level = level.withColumn("before", F.coalesce(F.sum("cap").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    level = level.withColumn("rest", F.sum("w").over(by.rowsBetween(0, Window.unboundedFollowing)))
    level = level.withColumn("lam", (F.sum("source_size").over(whole) * F.lit(SHARE) - F.col("before")) / F.col("rest"))
    level = level.withColumn("lam", F.min(F.when(F.col("lam") <= F.col("ratio"), F.struct("ratio", "source", "lam"))).over(whole)["lam"])
    return level.select("source", "source_size", F.least(F.col("cap").cast("double"), F.col("w") * F.coalesce("lam", F.col("ratio"))).alias("target"))


def _copies(rate: Column, seed: int) -> Column:
    """floor(rate), and one more if a hash of ``doc_id`` and the seed, as a number below 1, is under the rate's fraction."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    draw = F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))
    return (F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def _rates(docs: DataFrame) -> DataFrame:
    """Per source: source, source_size, target, rate; marked for broadcast if the sources are few."""
    sizes = docs.select("source", word_count().alias("size")).groupBy("source").agg(F.sum("size").alias("source_size"))
    rates = source_targets(sizes).withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
    few = docs.select("source").distinct().limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    return F.broadcast(rates) if few else rates


def mixture_plan(docs: DataFrame, seed: int = 0) -> DataFrame:
    """Per row: doc_id, source, size, source_size, target, rate, copies (how often the mix has it)."""
    sized = docs.select("doc_id", "source", word_count().alias("size"))
    rates = _rates(docs).withColumnRenamed("source", "__source")
    joined = sized.join(rates, F.col("source").eqNullSafe(F.col("__source")), "left").drop("__source")
    return joined.withColumn("copies", _copies(F.col("rate"), seed))


def emit_copies(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as its plan says, all columns kept."""
    source, rate, copy = free_names(docs, "__source", "__rate", "__copy")
    rates = _rates(docs).select(F.col("source").alias(source), F.col("rate").alias(rate))
    joined = docs.join(rates, F.col("source").eqNullSafe(F.col(source)), "left")
    times = F.array_repeat(F.lit(1), _copies(F.col(rate), seed).cast("int"))
    return joined.withColumn(copy, F.explode(times)).drop(source, rate, copy)


def op10_mix_sources(spark, sf_dir: str) -> DataFrame:
    plan = mixture_plan(documents(spark, sf_dir))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, ([3, 1, 2])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w FROM s
), r AS (
  SELECT *, (2 * source_size)::DOUBLE / w AS ratio, 2 * source_size AS cap FROM w
), l AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5
    - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / (sum(w) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS lam FROM r
), v AS (
  SELECT arg_min(lam, ratio) AS lam FROM l WHERE lam <= ratio
), t AS (
  SELECT source, source_size, least(cap::DOUBLE, w::DOUBLE * v.lam) AS target FROM r, v
), m AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE / 281474976710656.0::DOUBLE AS draw
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM m
"""
