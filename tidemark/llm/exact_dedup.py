"""Exact deduplication by skew-safe combining.

Three merges decide which row of a group of equal texts stays, and each compares full content, never a
digest alone: (1) equal texts of one input partition collapse before any shuffle (partial aggregation on
digest, salt and text); (2) the survivors merge per salted digest group; (3) the salt winners merge globally.
Only digests that hold more than ``1 / HOT_SHARE`` of all rows are salted, so at most ``HOT_SHARE`` of them
exist, whatever the input: that list is the only thing sent to every task. The share is of the rows there are, so the
rule is the same at every size; all other digest groups are already whole after merge 2, and salting them would change no result.

Defined results: null text equals empty text; repeated rows (equal ``doc_id`` too) are counted one by one and
all carry the flag of their ``doc_id``; a null ``doc_id`` never wins against a number and stays only if its group
has no other; an empty table gives an empty result; further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, free_names, staged, text_of

#: A digest is salted if it holds over 1 / HOT_SHARE of all rows; hence at most HOT_SHARE digests are.
HOT_SHARE = 200
SALTS = 32


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE, " ")


def content_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _rows(docs: DataFrame, id_col: str, text_col: str, digest) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), normalised(text_of(text_col)).alias("body")).withColumn("dig", digest(F.col("body")))


def _winners(rows: DataFrame, total: int) -> tuple[DataFrame, list[bytes]]:
    """A stored row per distinct text (dig, id, n, chars, mark, sha), and the salted digests."""
    hot = [bytes(r["dig"]) for r in rows.groupBy("dig").count().filter(F.col("count") > max(total // HOT_SHARE, 1)).select("dig").limit(HOT_SHARE).collect()]

    def merge(part: DataFrame, *keys: str) -> DataFrame:
        return part.groupBy(*keys, "body").agg(F.min("id").alias("id"), F.sum("n").alias("n"))

    one = rows.withColumn("n", F.lit(1).cast("long"))
    best = merge(one.filter(~_among(hot)), "dig")
    if hot:
        salted = merge(one.filter(_among(hot)).withColumn("salt", F.spark_partition_id() % SALTS), "dig", "salt")
        best = best.unionByName(merge(salted, "dig"))
    best = best.select("dig", "id", "n", F.length("body").alias("chars"), F.xxhash64("body").alias("mark"), F.sha2("body", 256).alias("sha"))
    return staged(best, "exact-winners"), hot


def _among(hot: list[bytes]) -> Column:
    return F.col("dig").isin([F.lit(d) for d in hot]) if hot else F.lit(False)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=content_digest) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    ``digest`` may be any function of the normalised text; a weak one costs time, not correctness.
    """
    rows = _rows(docs, id_col, text_col, digest)
    winners, hot = _winners(rows, docs.count())
    if winners.groupBy("dig").count().filter("count > 1").isEmpty():  # always so for SHA-256: the digest names the text
        keyed, on = rows.select("id", "dig"), ["dig"]
    else:  # a weak digest: rows find their text by everything known of it
        keyed = rows.select("id", "dig", F.length("body").alias("chars"), F.xxhash64("body").alias("mark"), F.sha2("body", 256).alias("sha"))
        on = ["dig", "chars", "mark", "sha"]
    best = winners.withColumnsRenamed({"id": "keep_id", "n": "group_size"})
    out = keyed.filter(~_among(hot)).join(best.filter(~_among(hot)), on)
    if hot:  # at most HOT_SHARE digests
        out = out.unionByName(keyed.filter(_among(hot)).join(F.broadcast(best.filter(_among(hot))), on))
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns; of repeated rows with the winning ``doc_id`` one stays."""
    total = docs.count()
    winners, _ = _winners(_rows(docs, "doc_id", "text", content_digest), total)
    one, best, sha = free_names(docs, "__id", "__keep", "__sha")
    keep = winners.select(F.col("id").alias(one), F.col("sha").alias(best))
    mine = docs.withColumn(sha, F.sha2(normalised(text_of()), 256))
    kept = mine.join(keep, F.col("doc_id").eqNullSafe(F.col(one)) & (F.col(sha) == F.col(best)), "left_semi")
    if docs.select("doc_id").distinct().count() < total:  # only then can a winner's row be there twice
        kept = kept.dropDuplicates(["doc_id", sha])
    return kept.drop(sha)


def op6_exact_dedup(spark, sf_dir: str) -> DataFrame:
    from tidemark.llm.common import documents

    return exact_groups(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP6_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, sha256(body) AS text_sha256
FROM d WINDOW w AS (PARTITION BY body)
"""
