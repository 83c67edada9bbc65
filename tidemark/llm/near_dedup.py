"""Similarity join of documents on word shingles by parity sketches; near-duplicate components.

Exact sets of distinct five-word shingles; two documents link at a Jaccard similarity of 0.75.

1. One pass gives each document the size and a 64-bit key of its set; equal sets are one class from here on, so copies
   never meet one by one. The same pass counts sketch tokens into a fixed number of cells, over all data.
2. A sketch XOR-hashes the shingles of a set into blocks. Linked sets of sizes a and b differ in at most (a + b) / 7 shingles, so
   in at most so many blocks; hence, in an order all sets share, their first (a + b) / 7 + 1 block tokens have one in
   common. Tokens in light cells come first, which keeps widespread passages out of the prefixes; the order changes the cost, not the result.
   Bands double in size; a set also joins the next band if a partner can be there. Tokens are dealt to as many buckets
   as the shingles ask for; cells too full for a bucket's memory go through a shuffled aggregation instead.
3. Sets under one token become a star of pairs around their least key, never all pairs. Sizes and the Hamming distance of
   parity bits, two to four a shingle, a lower bound of the symmetric difference, discard pairs; whole sets verify the others.
4. Components of verified links. Two sets that share a token are members of one leader's stars, whatever the tokens were; so the members
   of each leader, each once, are compared by their parity bits in blocks, and only pairs across components that these bits allow
   are made and verified: first the closest of each two components in a block, then, where components are still apart, all.
5. Links are counted, where asked for, within components: linked sets share one, and blocks of whole sets are compared as
   products of membership matrices. A component of two has the one link that made it.

Blocks (4 and 5): a group of up to BLOCK_SETS sets is one job; a larger one is cut by size class, so that links only reach the next
class, and by a hash of the set. A job holds two blocks and a task some jobs, whatever the size of a group; a set travels once
for each block it is compared with. No step pairs the rows of a group by a join.

Defined results: null text and text without words have no shingles, link with nothing and are their own component; fewer
than five words are one shingle; repeated rows are rows of one class; a null ``doc_id`` takes part, but names a component only
if the component has no other (then its component_id is null); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm import shingles as S
from tidemark.llm.common import documents, free_names, shuffle_partitions, staged, tidy
from tidemark.llm.components import components, merged

CELLS = 1 << 18
#: A cell counted more often than this is not dealt to a bucket (12 bytes an entry).
HOT_CELL = 4_000_000
ENTRIES_PER_BUCKET = 250_000
FLUSH = 300_000
#: Texts whose sets a task holds at once.
SLICE = 500
#: Up to this many representatives, their ids are broadcast; beyond it, texts and ids join by shuffle.
BROADCAST_IDS = 2_000_000
#: Sets that are compared with as many others in one job, shingles that a product takes at a time, and bytes of a task's jobs.
BLOCK_SETS = 256
BLOCK_GRAMS = 8192
TASK_BYTES = 8 << 20
#: Words of parity bits that are compared at once.
SPAN_WORDS = 1 << 20
#: Groups cut into blocks are broadcast up to this number; beyond it, their members meet them by shuffle.
BROADCAST_GROUPS = 100_000


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, SLICE):
            yield batch.slice(a, SLICE)


def _ids(docs: DataFrame) -> str:
    return dict(docs.dtypes)["doc_id"]


def profile(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """Stored rows (doc_id, n, sig, wide) and the count of sketch tokens by cell."""
    names = ["doc_id", "n", "sig", "wide", "cell", "count"]
    kinds = [to_arrow_type(docs.schema["doc_id"].dataType), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, seen = np.zeros(CELLS, np.int64), set()
        for batch in _slices(batches):
            sets = S.shingle_sets(batch.column("text").to_pylist())
            sigs = [S.class_key(s) if len(s) else None for s in sets]
            for s, sig in zip(sets, sigs, strict=True):
                if sig is not None and sig not in seen:
                    seen.add(sig)
                    for band, _ in S.bands(len(s)):
                        np.add.at(weight, S.cells(S.block_tokens(s, band)[0], weight), 1)
            wide = [S.parity_words(s, S.wide_bits(len(s))) for s in sets]
            wide = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, wide)]), pa.int32()), pa.array(np.concatenate(wide)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(sigs, pa.int64()), wide, *[pa.nulls(len(sets), k) for k in kinds[4:]]], names)
        used = np.flatnonzero(weight)
        yield pa.RecordBatch.from_arrays([*[pa.nulls(1, k) for k in kinds[:4]], pa.array([used.astype(np.int32)], kinds[4]), pa.array([weight[used]], kinds[5])], names)

    schema = f"doc_id {_ids(docs)}, n bigint, sig bigint, wide array<bigint>, cell array<int>, count array<bigint>"
    both = staged(docs.select("doc_id", "text").mapInArrow(tidy(run), schema), "near-profile")
    counted = both.filter("cell IS NOT NULL").select(F.explode(F.arrays_zip("cell", "count")).alias("c")).groupBy("c.cell").agg(F.sum("c.count").alias("n")).toPandas()  # CELLS rows at most
    weight = np.zeros(CELLS, np.int64)
    weight[counted["cell"].to_numpy()] = counted["n"].to_numpy()
    return both.filter("cell IS NULL").drop("cell", "count"), weight


def _token_rows(docs: DataFrame, weight: np.ndarray, buckets: int, hot_cell: int) -> DataFrame:
    """Rows (bucket, entries) of packed (low half of the token, class); bucket -1: tokens of hot cells, packed whole."""
    hot = weight > hot_cell
    shared = docs.sparkSession.sparkContext.broadcast(weight)  # CELLS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, seen, held, size = shared.value, set(), [], 0

        def flush() -> pa.RecordBatch:
            tokens, sigs = (np.concatenate(x) for x in zip(*held, strict=True)) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            apart = hot[S.cells(tokens, weight)]
            bucket = (((tokens >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
            bucket[apart] = -1
            order = np.argsort(bucket, kind="stable")
            bucket, tokens, sigs = bucket[order], tokens[order], sigs[order]
            first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, int)
            packed = []
            for a, z in zip(first, np.append(first[1:], len(bucket)), strict=False):  # no rows: no first
                kind = "<u8" if bucket[a] < 0 else "<u4"
                packed.append(tokens[a:z].astype(kind).tobytes() + sigs[a:z].astype("<i8").tobytes())
            return pa.RecordBatch.from_arrays([pa.array(bucket[first], pa.int64()), pa.array(packed, pa.binary())], ["bucket", "entries"])

        for batch in _slices(batches):
            for s in S.shingle_sets(batch.column("text").to_pylist()):
                if not len(s) or (sig := S.class_key(s)) in seen:
                    continue
                seen.add(sig)
                for band, differ in S.bands(len(s)):
                    t = S.prefix_tokens(s, band, differ, weight)
                    held.append((t, np.full(len(t), sig, np.int64)))
                    size += len(t)
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        yield flush()

    return docs.select("text").mapInArrow(tidy(run), "bucket bigint, entries binary")


def _stars(tokens: np.ndarray, sigs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs (a, b): the least class under a token, and another one under it."""
    order = np.lexsort((sigs, tokens))
    tokens, sigs = tokens[order], sigs[order]
    first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) if len(tokens) else np.zeros(0, int)
    lead = np.repeat(sigs[first], np.diff(np.append(first, len(tokens))))
    lead, other = lead[lead != sigs], sigs[lead != sigs]
    order = np.lexsort((other, lead))
    lead, other = lead[order], other[order]
    fresh = np.concatenate([[True], (lead[1:] != lead[:-1]) | (other[1:] != other[:-1])]) if len(lead) else np.zeros(0, bool)
    return lead[fresh], other[fresh]


def candidate_stars(docs: DataFrame, weight: np.ndarray, entries: int, hot_cell: int = HOT_CELL) -> DataFrame:
    """Stored pairs (a, b), each once: a leader and a member of its stars."""
    buckets = max(shuffle_partitions(docs.sparkSession), -(-entries // ENTRIES_PER_BUCKET))
    rows = _token_rows(docs, weight, buckets, hot_cell)
    schema = "a bigint, b bigint"

    def run(table: pa.Table) -> pa.Table:
        tokens, sigs = [], []
        for e in table.column("entries"):
            raw = e.as_py()
            n = len(raw) // 12
            tokens.append(np.frombuffer(raw, "<u4", n))
            sigs.append(np.frombuffer(raw, "<i8", n, 4 * n))
        return pa.table([pa.array(x, pa.int64()) for x in _stars(np.concatenate(tokens), np.concatenate(sigs))], ["a", "b"])

    if not (weight > hot_cell).any():
        stars = rows.groupBy("bucket").applyInArrow(run, schema)
    else:
        rows = staged(rows, "near-tokens")
        stars = rows.filter("bucket >= 0").groupBy("bucket").applyInArrow(run, schema)

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for e in batch.column("entries"):
                    raw = e.as_py()
                    n = len(raw) // 16
                    yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(raw, "<i8", n)), pa.array(np.frombuffer(raw, "<i8", n, 8 * n))], ["g", "b"])

        hot = rows.filter("bucket < 0").mapInArrow(spread, "g bigint, b bigint").distinct()
        lead = hot.groupBy("g").agg(F.min("b").alias("a"))
        stars = stars.unionByName(hot.join(lead, "g").filter("b <> a").select("a", "b"))
    return staged(stars.distinct(), "near-stars", light=True)


def _within_bounds(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sizes and wide sketches allow a link."""
    left, right = (classes.select(F.col("sig").alias(x), F.col("n").alias(f"n{x}"), F.col("wide").alias(f"s{x}")) for x in "ab")
    both = pairs.join(left, "a").join(right, "b").filter(_sizes_fit())
    words = F.least(F.size("sa"), F.size("sb"))

    def folded(s: str):
        half = F.zip_with(F.slice(s, F.lit(1), words), F.slice(s, words + 1, words), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(s) > words, half).otherwise(F.col(s))

    return both.withColumns({"sa": folded("sa"), "sb": folded("sb")}).filter(_sketches_fit()).select("a", "b")


def _sizes_fit():
    return 4 * F.least("na", "nb") >= 3 * F.greatest("na", "nb")


def _sketches_fit():
    apart = F.aggregate(F.zip_with("sa", "sb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, d: t + d)
    return 7 * apart <= F.col("na") + F.col("nb")


def _sets_of(reps: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows (sig, grams) of the documents with the ids ``reps``: key and whole set."""
    reps = staged(reps, "near-reps", light=True)
    few = reps.count() <= BROADCAST_IDS
    side = (F.broadcast(reps) if few else reps).withColumnRenamed("doc_id", "__id")
    texts = docs.select("doc_id", "text").join(side, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            sets = [s for s in S.shingle_sets(batch.column("text").to_pylist()) if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([S.class_key(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["sig", "grams"])

    return texts.mapInArrow(tidy(run), "sig bigint, grams binary")


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets link."""
    wanted = pairs.select(F.col("a").alias("sig")).unionByName(pairs.select(F.col("b").alias("sig"))).distinct()
    sets = _sets_of(wanted.join(classes.select("sig", "rep"), "sig").select(F.col("rep").alias("doc_id")).distinct(), docs)  # both joins below read one shuffle of it

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                keep.append(100 * both >= 75 * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    whole = pairs.join(sets.select(F.col("sig").alias("b"), F.col("grams").alias("y")), "b").join(sets.select(F.col("sig").alias("a"), F.col("grams").alias("x")), "a")
    # a repeated doc_id can bring a set more than once
    return staged(whole.select("a", "b", "x", "y").mapInArrow(check, "a bigint, b bigint").distinct(), "near-links", light=True)


def _shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set of ``left`` shares with each of ``right``."""
    sets = [*left, *right]
    grams, at = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    inside = owner < len(left)
    both = (np.bincount(at[inside], minlength=len(grams)) > 0) & (np.bincount(at[~inside], minlength=len(grams)) > 0)
    keep, place = both[at], np.cumsum(both) - 1
    owner, at = owner[keep], place[at[keep]]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    out = np.zeros((len(left), len(right)), np.float64)
    for low in range(0, int(both.sum()), BLOCK_GRAMS):
        a, z = np.searchsorted(at, [low, low + BLOCK_GRAMS])
        there = np.zeros((len(sets), BLOCK_GRAMS), np.float32)
        there[owner[a:z], at[a:z] - low] = 1
        out += there[: len(left)] @ there[len(left) :].T
    return out


#: Size classes: linked sets (sizes up to 4/3 apart) are in one or in adjacent ones.
_CLASS = 1.34


def _jobs(members: DataFrame, width) -> DataFrame:
    """``members`` (group, sig, n) dealt to jobs: group, sig, job, side (0 left, 1 right, 2 both), bucket.

    Each two members of a group whose sizes allow a link meet in one job. ``width``: bytes that a member brings to a job.
    """
    members = members.withColumn("k", F.floor(F.log(F.col("n")) / F.lit(float(np.log(_CLASS)))).cast("int"))
    sizes = members.groupBy("group", "k").agg(F.count("*").alias("c"))
    large = sizes.groupBy("group").agg(F.sum("c").alias("m"), F.collect_list(F.struct("k", F.ceil(F.col("c") / BLOCK_SETS).cast("int").alias("blocks"))).alias("cut")).filter(F.col("m") > BLOCK_SETS)
    large = staged(large.select("group", F.map_from_entries("cut").alias("cut")), "near-large", light=True)
    large = F.broadcast(large) if large.count() <= BROADCAST_GROUPS else large
    k, cut = F.col("k"), lambda step: F.coalesce(F.try_element_at("cut", F.col("k") + step), F.lit(0))
    mine = F.pmod(F.xxhash64("sig"), F.col("own")).cast("int")

    def meets(n, use):
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), use)).otherwise(F.array().cast("array<struct<job:bigint,side:int>>"))

    def job(k1, x, k2, y, side):
        return F.struct(F.xxhash64("group", k1, x, k2, y).alias("job"), side.cast("int").alias("side"))

    same = meets(F.col("own"), lambda y: job(k, F.least(y, mine), k, F.greatest(y, mine), F.when(y == mine, 2).when(y < mine, 1).otherwise(0)))
    up = meets(cut(1), lambda y: job(k, mine, k + 1, y, F.lit(0)))
    down = meets(cut(-1), lambda y: job(k - 1, y, k, mine, F.lit(1)))
    alone = F.array(F.struct(F.xxhash64("group").alias("job"), F.lit(2).alias("side")))
    placed = members.join(large, "group", "left").withColumn("own", cut(0)).withColumn("at", F.when(F.col("cut").isNull(), alone).otherwise(F.concat(same, up, down)))
    placed = staged(placed.select("group", "sig", "n", "at"), "near-jobs", light=True)
    total = placed.agg(F.sum(width * F.size("at"))).first()[0] or 0
    buckets = max(shuffle_partitions(members.sparkSession), -(-int(total) // TASK_BYTES))
    return placed.select("group", "sig", F.explode("at").alias("at")).select("group", "sig", "at.*", F.pmod(F.xxhash64("at.job"), F.lit(buckets)).alias("bucket"))


def _each_job(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per job of a task: rows of the left block, rows of the right one, and which of all pairs of them are meant."""
    jobs, sides = table.column("job").to_numpy(), table.column("side").to_numpy()
    order = np.argsort(jobs, kind="stable")
    ends = np.append(np.flatnonzero(np.diff(jobs[order])) + 1, len(order))
    for a, z in zip(np.append(0, ends[:-1]), ends, strict=True):
        rows = order[a:z]
        side = sides[rows]
        left, right = rows[side != 1], rows[side != 0]
        wanted = np.ones((len(left), len(right)), bool)
        yield left, right, np.triu(wanted, 1) if side[0] == 2 else wanted


def _sketch_pairs(table: pa.Table, closest: bool) -> pa.Table:
    """Pairs (a, b) across components whose parity bits allow a link; of each two components in a job on demand only the closest."""
    sig, n, component = (table.column(c).to_numpy() for c in ("sig", "n", "component"))
    wide = table.column("wide").combine_chunks()
    ends, words = wide.offsets.to_numpy(), wide.values.to_numpy().view(np.uint64)  # bitwise_count takes a signed word by its absolute value
    size = np.diff(ends)
    found = [np.zeros((0, 2), np.int64)]
    for left, right, wanted in _each_job(table):
        small, big = np.minimum(n[left][:, None], n[right][None, :]), np.maximum(n[left][:, None], n[right][None, :])
        i, j = np.nonzero(wanted & (component[left][:, None] != component[right][None, :]) & (4 * small >= 3 * big))
        if not len(i):
            continue
        one, two = left[i], right[j]
        apart, level = np.zeros(len(one), np.int64), np.minimum(size[one], size[two])
        for w in np.unique(level).tolist():
            at = np.flatnonzero(level == w)
            used, place = np.unique(np.concatenate([one[at], two[at]]), return_inverse=True)
            bits = np.stack([_folded(words[ends[r] : ends[r + 1]], w) for r in used])
            x, y = place[: len(at)], place[len(at) :]
            step = max(1, SPAN_WORDS // w)
            for a in range(0, len(at), step):
                apart[at[a : a + step]] = np.bitwise_count(bits[x[a : a + step]] ^ bits[y[a : a + step]]).sum(axis=1, dtype=np.int64)
        keep = np.flatnonzero(7 * apart <= n[one] + n[two])
        if closest and len(keep):
            ca, cb = component[one[keep]], component[two[keep]]
            low, high = np.minimum(ca, cb), np.maximum(ca, cb)
            keep = keep[np.lexsort((apart[keep] / (n[one[keep]] + n[two[keep]]), high, low))]
            ca, cb = component[one[keep]], component[two[keep]]
            low, high = np.minimum(ca, cb), np.maximum(ca, cb)
            keep = keep[np.concatenate([[True], (low[1:] != low[:-1]) | (high[1:] != high[:-1])])]
        pair = np.stack([sig[one[keep]], sig[two[keep]]], axis=1)
        found.append(np.sort(pair, axis=1))
    pairs = np.unique(np.concatenate(found), axis=0)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


def _folded(words: np.ndarray, size: int) -> np.ndarray:
    while len(words) > size:
        half = len(words) // 2
        words = words[:half] ^ words[half:]
    return words


def _across(jobs: DataFrame, classes: DataFrame, tied: DataFrame, closest: bool) -> DataFrame:
    """Stored pairs (a, b) of members of one leader that are in different components and may link."""
    placed = classes.select("sig", "n", "wide").join(tied.withColumnRenamed("node", "sig"), "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    whole = jobs.join(placed, "sig").select("bucket", "job", "side", "sig", "n", "component", "wide")
    found = whole.groupBy("bucket").applyInArrow(lambda table: _sketch_pairs(table, closest), "a bigint, b bigint")
    return staged(found.distinct(), "near-pairs", light=True)


def _edges(links: DataFrame) -> DataFrame:
    return links.select(F.col("a").alias("u"), F.col("b").alias("v"))


def link_counts(tied: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Stored rows (sig, n_links) of every class that links: all links, from whole sets."""
    size = tied.groupBy("component").agg(F.count("*").alias("m"))
    placed = tied.withColumnRenamed("node", "sig").join(size, "component").join(classes.select("sig", "rep", "n"), "sig")
    placed = staged(placed.withColumnRenamed("component", "group"), "near-members")
    large = placed.filter("m > 2")
    jobs = _jobs(large.select("group", "sig", "n"), 8 * F.col("n"))
    # a repeated doc_id can bring a set more than once
    sets = _sets_of(large.select(F.col("rep").alias("doc_id")).distinct(), docs).groupBy("sig").agg(F.first("grams").alias("grams"))

    def run(table: pa.Table) -> pa.Table:
        sig, grams = table.column("sig").to_numpy(), [np.frombuffer(g.as_py(), np.uint64) for g in table.column("grams")]
        n, counts = np.array([len(g) for g in grams], np.float64), np.zeros(len(grams), np.int64)
        for left, right, wanted in _each_job(table):
            both = _shared_counts([grams[r] for r in left], [grams[r] for r in right])
            linked = wanted & (100 * both >= 75 * (n[left][:, None] + n[right][None, :] - both))
            np.add.at(counts, left, linked.sum(axis=1))
            np.add.at(counts, right, linked.sum(axis=0))
        return pa.table({"sig": sig, "n_links": counts})

    counted = jobs.select("bucket", "job", "side", "sig").join(sets, "sig").groupBy("bucket").applyInArrow(run, "sig bigint, n_links bigint").groupBy("sig").agg(F.sum("n_links").alias("n_links"))
    return staged(placed.filter("m = 2").select("sig", F.lit(1).cast("long").alias("n_links")).unionByName(counted), "near-degrees", light=True)


def near_groups(docs: DataFrame, hot_cell: int = HOT_CELL, count_links: bool = True) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id and, unless not wanted, n_links (all other classes that its class links with)."""
    light, weight = profile(docs)
    classes = staged(light.filter("sig IS NOT NULL").groupBy("sig").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.first("wide").alias("wide")), "near-classes")
    stars = candidate_stars(docs, weight, int(weight.sum()), hot_cell)
    tied = components(_edges(verified(staged(_within_bounds(stars, classes), "near-pairs", light=True), docs, classes)))
    # What the stars left apart: members of one leader, across components.
    jobs = _jobs(stars.select(F.col("a").alias("group"), F.col("b").alias("sig")).join(classes.select("sig", "n"), "sig"), F.col("n") / 2 + 64)
    for closest in (True, False):
        pairs = _across(jobs, classes, tied, closest)
        if pairs.isEmpty():
            break
        tied = merged(tied, _edges(verified(pairs, docs, classes)))
    named = classes.select("sig", "rep").join(tied.withColumnRenamed("node", "sig"), "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_class = named.join(least, "component").select("sig", "component_id")
    if count_links:
        of_class = of_class.join(link_counts(tied, docs, classes), "sig", "left")
    out = light.select("doc_id", "n", "sig").join(of_class, "sig", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), *([F.coalesce("n_links", F.lit(0)).alias("n_links")] if count_links else []))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose component has a smaller ``doc_id``; rows that repeat the staying id stay once."""
    groups = near_groups(docs, count_links=False).filter(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    (name,) = free_names(docs, "__id")
    gone = staged(groups.select(F.col("doc_id").alias(name)).distinct(), "near-gone", light=True)
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col(name)), "left_anti")


def op9_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir))
