"""Masked pseudo-likelihood with a bidirectional window network.

Words are counted over the whole corpus; the commonest get a class each, all others share hashed classes. A token scores
log P(class | context) + log P(word | class): the second is the word's share of all tokens of its class, from the full table of word
counts, which is never in one place (words go by 64-bit hashes to buckets, counts come back to the texts). A network of one
hidden layer sees the classes of the two words before and the two after a masked position and predicts the class between.
It is trained in numpy by local gradient descent: in every round each task starts from the common weights, walks over its
share of the positions of all its documents (every other one of two rounds, where each text starts by a hash), and the weights are averaged
by the number of positions; so the weights, and by a little the scores, depend on how Spark splits the files. Over the rounds every position of every text is a target exactly once. Scoring masks every position of every whole text in turn and sums log-probabilities.

Defined results: null and blank texts have no words: n_words 0, log_prob 0, mean_log_prob null; null ``doc_id`` and repeated
rows are scored row by row; without any words the network is never asked; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm import shingles as S
from tidemark.llm.common import documents, shuffle_partitions, staged, text_of, tidy

OWN, SHARED = 95, 32  # classes: 0 is the edge of a text, then the commonest words, then hashed classes
CLASSES = 1 + OWN + SHARED
OFFSETS = (-2, -1, 1, 2)
HIDDEN = 16
ROUNDS = 2
RATE, BATCH = 0.5, 256
BLOCK = 32_768
#: Characters of text whose words share a vocabulary, and counts that a bucket of words takes.
CHUNK = 4 << 20
ENTRIES_PER_BUCKET = 500_000

_BLANKS = bytes(32 if 9 <= b <= 13 else b for b in range(256))


def _hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word of all texts, and per text the number of its first word, and the end; made from a bounded part of the texts at a time."""
    words, edges, held, size = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)], [], 0
    for i, t in enumerate(texts):
        held.append(t.encode().translate(_BLANKS))
        size += len(held[-1])
        if size >= S.CHUNK or i + 1 == len(texts):
            w, e = S.words_of(held)
            words.append(w)
            edges.append(edges[-1][-1] + e[1:])
            held, size = [], 0
    return np.concatenate(words), np.concatenate(edges)


def _chunks(docs: DataFrame) -> DataFrame:
    """Stored, a row per chunk of texts: their doc_ids and sizes, the words as numbers of the chunk's sorted vocabulary, and its counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, keys, texts, size = 0, [], [], 0

        def flush() -> pa.RecordBatch:
            words, edges = _hashes(texts)
            vocabulary, at, n = np.unique(words, return_inverse=True, return_counts=True)
            row = [(TaskContext.get().partitionId() << 40) + made, keys, np.diff(edges), at.astype("<i4").tobytes(), vocabulary.astype("<u8").tobytes(), n.astype("<i8").tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

        for batch in batches:
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                keys.append(key)
                texts.append(text.as_py())
                size += len(texts[-1])
                if size >= CHUNK:
                    yield flush()
                    made, keys, texts, size = made + 1, [], [], 0
        if keys:
            yield flush()

    kinds = [pa.int64(), pa.list_(to_arrow_type(docs.schema["doc_id"].dataType)), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
    names = ["chunk", "doc_ids", "sizes", "at", "vocabulary", "n"]
    schema = f"chunk bigint, doc_ids array<{dict(docs.dtypes)['doc_id']}>, sizes array<bigint>, at binary, vocabulary binary, n binary"
    return staged(docs.select("doc_id", text_of().alias("text")).mapInArrow(tidy(run), schema), "lm-chunks")


def _totals(chunks: DataFrame) -> DataFrame:
    """Stored: per chunk and bucket the whole table's count of each of the chunk's words (n); and, with a null chunk, of each bucket
    the commonest words (words, n). A bucket is a range of hashes, dealt all counts of its words."""
    entries = chunks.agg(F.sum(F.length("vocabulary"))).first()[0] or 0
    buckets = max(shuffle_partitions(chunks.sparkSession), -(-entries // (8 * ENTRIES_PER_BUCKET)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, words, n in zip(*(batch.column(c).to_pylist() for c in ("chunk", "vocabulary", "n")), strict=True):
                words, n = np.frombuffer(words, "<u8"), np.frombuffer(n, "<i8")
                bucket = (((words >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
                first = np.flatnonzero(np.diff(bucket, prepend=-1))
                spans = list(zip(first, np.append(first[1:], len(bucket)), strict=False))
                yield pa.RecordBatch.from_arrays([pa.array(bucket[first]), pa.array([chunk] * len(spans), pa.int64()), pa.array([words[a:z].tobytes() for a, z in spans], pa.binary()), pa.array([n[a:z].tobytes() for a, z in spans], pa.binary())], ["bucket", "chunk", "words", "n"])

    def add(table: pa.Table) -> pa.Table:
        raws = [w.as_py() for w in table.column("words")]
        words, at = np.unique(np.frombuffer(b"".join(raws), "<u8"), return_inverse=True)
        n = np.zeros(len(words), np.int64)
        np.add.at(n, at, np.frombuffer(b"".join(v.as_py() for v in table.column("n")), "<i8"))
        ends = np.cumsum([len(w) // 8 for w in raws])[:-1]
        top = np.lexsort((words, -n))[:OWN]
        back = [v.tobytes() for v in np.split(n[at], ends)]
        rows = len(back)
        return pa.table({
            "bucket": pa.concat_arrays([table.column("bucket").combine_chunks(), pa.nulls(1, pa.int64())]), "chunk": pa.concat_arrays([table.column("chunk").combine_chunks(), pa.nulls(1, pa.int64())]),
            "n": pa.array([*back, n[top].tobytes()], pa.binary()), "words": pa.array([None] * rows + [words[top].tobytes()], pa.binary()),
        })

    pieces = chunks.select("chunk", "vocabulary", "n").mapInArrow(tidy(deal), "bucket bigint, chunk bigint, words binary, n binary")
    return staged(pieces.groupBy("bucket").applyInArrow(add, "bucket bigint, chunk bigint, n binary, words binary"), "lm-counts")


def _shared(words: np.ndarray) -> np.ndarray:
    """The shared class of each word, from 0."""
    return (words % np.uint64(SHARED)).astype(np.int64)


def _commonest(totals: DataFrame) -> np.ndarray:
    """Hashes of the OWN commonest words, commonest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, n in zip(batch.column("words").to_pylist(), batch.column("n").to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(words, "<i8")), pa.array(np.frombuffer(n, "<i8"))], ["word", "n"])

    rows = totals.filter("chunk IS NULL").select("words", "n").mapInArrow(run, "word bigint, n bigint")
    return np.array([r["word"] for r in rows.orderBy(F.desc("n"), "word").limit(OWN).collect()], np.int64).view(np.uint64)


def _coded(chunks: DataFrame, totals: DataFrame, common: np.ndarray) -> tuple[DataFrame, np.ndarray]:
    """Stored rows (doc_id, classes, within): the class of every word, a byte each, and the sum of log P(word | class); and the count of each class."""
    order = np.argsort(common)
    ranked, number = common[order], (1 + order).astype(np.int64)

    def classes_of(words: np.ndarray) -> np.ndarray:
        of = 1 + OWN + _shared(words)
        if len(ranked):
            near = np.minimum(np.searchsorted(ranked, words), len(ranked) - 1)
            of = np.where(ranked[near] == words, number[near], of)
        return of

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        per = np.zeros(CLASSES, np.int64)
        for batch in batches:
            for words, n in zip(batch.column("vocabulary").to_pylist(), batch.column("n").to_pylist(), strict=True):
                np.add.at(per, classes_of(np.frombuffer(words, "<u8")), np.frombuffer(n, "<i8"))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(per)], ["k", "n"])

    per = np.zeros(CLASSES)
    for r in chunks.select("vocabulary", "n").mapInArrow(tally, "k bigint, n bigint").groupBy("k").agg(F.sum("n").alias("n")).collect():  # CLASSES rows at most
        per[r["k"]] = r["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("sizes", "at", "vocabulary", "counts")}
                of = classes_of(np.frombuffer(row["vocabulary"], "<u8"))
                n = np.frombuffer(b"".join(c["n"] for c in row["counts"] or []), "<i8")
                share = np.where(of > OWN, np.log(n) - np.log(np.maximum(per[of], 1)), 0.0)  # a word with a class of its own is all of it
                at, sizes = np.frombuffer(row["at"], "<i4"), np.array(row["sizes"], np.int64)
                ends = np.cumsum(sizes)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                raw = of.astype(np.uint8)[at].tobytes()
                coded = [raw[z - s : z] for s, z in zip(sizes.tolist(), ends.tolist(), strict=True)]
                doc_ids = batch.column("doc_ids")
                yield pa.RecordBatch.from_arrays([doc_ids.slice(i, 1).flatten(), pa.array(coded, pa.binary()), pa.array(np.bincount(owner, share[at], len(sizes)))], ["doc_id", "classes", "within"])

    back = totals.filter("chunk IS NOT NULL").groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("counts"))
    whole = chunks.drop("n").join(back, "chunk", "left").select("doc_ids", "sizes", "at", "vocabulary", "counts")
    kind = chunks.schema["doc_ids"].dataType.elementType.simpleString()
    return staged(whole.mapInArrow(tidy(run), f"doc_id {kind}, classes binary, within double"), "lm-classes"), per


def encode(docs: DataFrame, common: list[bytes]) -> DataFrame:
    """Rows (doc_id, classes, within) of :func:`_coded`, ``common`` having classes of their own."""
    chunks = _chunks(docs)
    return _coded(chunks, _totals(chunks), S.words_of(common)[0])[0]


class Network:
    """One flat vector of weights, with named views of it."""

    SHAPES = {"tables": (len(OFFSETS), CLASSES, HIDDEN), "inner": (HIDDEN,), "out": (HIDDEN, CLASSES), "bias": (CLASSES,)}

    def __init__(self, flat: np.ndarray):
        self.flat, at = flat.astype(np.float32), 0
        for name, shape in self.SHAPES.items():
            size = int(np.prod(shape))
            setattr(self, name, self.flat[at : at + size].reshape(shape))
            at += size

    @classmethod
    def fresh(cls, counts: np.ndarray) -> "Network":
        rng = np.random.default_rng(7)
        net = cls(np.zeros(sum(int(np.prod(s)) for s in cls.SHAPES.values())))
        net.tables[:] = rng.normal(0, 0.1, net.tables.shape)
        net.out[:] = rng.normal(0, 0.1, net.out.shape)
        net.bias[:] = np.log((counts + 1) / (counts.sum() + len(counts)))
        return net

    def hidden(self, context: np.ndarray) -> np.ndarray:
        z = self.inner + self.tables[0][context[:, 0]]
        for j in range(1, len(OFFSETS)):
            z += self.tables[j][context[:, j]]
        return np.tanh(z)

    def log_probs(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        logits = self.hidden(context) @ self.out + self.bias
        logits -= logits.max(axis=1, keepdims=True)
        own = logits[np.arange(len(target)), target]
        return own - np.log(np.exp(logits, out=logits).sum(axis=1))

    def learn(self, context: np.ndarray, target: np.ndarray, rate: float) -> None:
        n = len(target)
        h = self.hidden(context)
        logits = h @ self.out + self.bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(n), target] -= 1
        p /= n
        back = (p @ self.out.T) * (1 - h * h)
        self.out -= rate * (h.T @ p)
        self.bias -= rate * p.sum(axis=0)
        self.inner -= rate * back.sum(axis=0)
        for j in range(len(OFFSETS)):
            one = np.zeros((CLASSES, n), np.float32)
            one[context[:, j], np.arange(n)] = 1
            self.tables[j] -= rate * (one @ back)


def windows(classes: np.ndarray, first: int = 0, step: int = 1) -> np.ndarray:
    """The context of every position, or of every ``step``-th from ``first`` on: a column per offset, 0 beyond the ends."""
    reach = max(map(abs, OFFSETS))
    padded = np.zeros(len(classes) + 2 * reach, np.uint8)
    padded[reach : reach + len(classes)] = classes
    return np.stack([padded[reach + o : reach + o + len(classes)][first::step] for o in OFFSETS], axis=1)


def targets(row: bytes, r: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Contexts and classes of the positions a text gives in round ``r``: each position in exactly one of the rounds."""
    c, first = np.frombuffer(row, np.uint8), (zlib.crc32(row) + r) % rounds
    return windows(c, first, rounds), c[first::rounds]


def train(coded: DataFrame, counts: np.ndarray, rounds: int = ROUNDS) -> Network:
    net = Network.fresh(counts)
    for r in range(rounds):
        start = net.flat

        def run(batches: Iterator[pa.RecordBatch], start=start, r=r) -> Iterator[pa.RecordBatch]:
            mine, seen, held, size = Network(start.copy()), 0, [], 0
            for batch in batches:
                for row in batch.column("classes"):
                    got = targets(row.as_py(), r, rounds)
                    if len(got[1]):
                        held.append(got)
                        size += len(got[1])
                    if size >= BATCH:
                        context, target = (np.concatenate(x) for x in zip(*held, strict=True))
                        for a in range(0, len(target), BATCH):
                            mine.learn(context[a : a + BATCH], target[a : a + BATCH], RATE / (1 + r))
                        seen, held, size = seen + len(target), [], 0
            if held:
                context, target = (np.concatenate(x) for x in zip(*held, strict=True))
                mine.learn(context, target, RATE / (1 + r))
                seen += len(target)
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(mine.flat)), pa.int32()), pa.array(mine.flat.astype(np.float64) * seen), pa.array(np.full(len(mine.flat), seen), pa.int64())], ["k", "v", "n"])

        got = coded.select("classes").mapInArrow(run, "k int, v double, n bigint").groupBy("k").agg((F.sum("v") / F.sum("n")).alias("v")).toPandas()
        if len(got):  # a row per weight
            flat = np.zeros(len(start))
            flat[got["k"].to_numpy()] = got["v"].to_numpy()
            net = Network(flat)
    return net


def score(coded: DataFrame, net: Network) -> DataFrame:
    flat = net.flat

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(flat)
        for batch in batches:
            texts = [np.frombuffer(r.as_py(), np.uint8) for r in batch.column("classes")]
            sizes = np.array([len(t) for t in texts], np.int64)
            sums = np.zeros(len(texts))  # of log P(class | context)
            first = 0
            while first < len(texts):  # documents together up to a block; a longer one in blocks of its own
                last, size = first, 0
                while last < len(texts) and (last == first or size + sizes[last] <= BLOCK):
                    size += int(sizes[last])
                    last += 1
                if size:
                    context, target = np.concatenate([windows(t) for t in texts[first:last]]), np.concatenate(texts[first:last])
                    lp = np.concatenate([net.log_probs(context[a : a + BLOCK], target[a : a + BLOCK]) for a in range(0, size, BLOCK)]).astype(np.float64)
                    owner = np.repeat(np.arange(last - first), sizes[first:last])
                    sums[first:last] = np.bincount(owner, lp, last - first)
                first = last
            sums += batch.column("within").to_numpy()
            mean = [s / n if n else None for s, n in zip(sums.tolist(), sizes.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes), pa.array(sums), pa.array(mean, pa.float64())], ["doc_id", "n_words", "log_prob", "mean_log_prob"])

    return coded.mapInArrow(run, f"doc_id {dict(coded.dtypes)['doc_id']}, n_words bigint, log_prob double, mean_log_prob double")


def fit(docs: DataFrame) -> tuple[DataFrame, Network]:
    chunks = _chunks(docs)
    totals = _totals(chunks)
    coded, per = _coded(chunks, totals, _commonest(totals))
    return coded, train(coded, per)


def op5_lm_score(spark, sf_dir: str) -> DataFrame:
    coded, net = fit(documents(spark, sf_dir))
    return score(coded, net)
