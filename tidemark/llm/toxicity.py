"""Toxicity: boosted trees over dense features, calibrated by isotonic regression.

The lexicon is learned: words and word beginnings whose presence in labelled training documents goes with the label
(log-likelihood ratio, a least share of the toxic documents; every such word is a candidate, at most 1 / LEAST_SHARE
times the words and beginnings of a mean toxic document); each keeps its log-odds as a weight. Features are densities of lexicon words, also of such that are spelled with digits
or symbols, their distance to second-person words, and rates of capitals, punctuation and obfuscated tokens. Labels, lang,
source and doc_id are no inputs. Learning uses at most ``SAMPLE`` labelled rows, the first by a hash of their id, none of
the held-out fifth; scoring reads every whole text once, without a shuffle.

Defined results: null text is empty and gets the score of a text without any signs; rows with a null label or
null ``doc_id`` teach nothing; of repeated labels of a document the highest counts; repeated rows are scored alike, one by one;
without any label of one kind every score is the mean label (0 without labels); an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.boosting import Boosted, Isotonic
from tidemark.llm.common import documents, held_out, labels, staged, text_of, tidy

#: Labelled rows that the model is fitted on, at most.
SAMPLE = 20_000
LEXICON = 96
#: A lexicon entry is in this share of the toxic training documents, and in so many, at least.
LEAST_SHARE, LEAST_DOCS = 0.01, 4
#: Lengths of word beginnings that may be entries; they are written with a star.
STEMS = (4, 5, 6)
NEAR = 8
#: Words that one Python worker remembers.
MEMO = 150_000

# Words of the second person in English, German, French and Spanish.
SECOND_PERSON = frozenset("you your yours yourself du dich dir dein deine sie ihr euch tu te toi ton ta vous votre usted ustedes tú ti vosotros".split())

_WORD = re.compile(r"[^\W_]+")
_MIXED = re.compile(r"[^\W\d_]+[\d@$!*#._-]+[^\W\d_][\w@$!*#-]*|[@$!*#\d][^\W\d_]+[\w@$!*#]*")
_PLAIN = str.maketrans("013457@$!", "oieastasi")


def units(words: set[str]) -> set[str]:
    """What could be lexicon entries: the words, and their beginnings."""
    return words.union(f"{w[:k]}*" for w in words for k in STEMS if len(w) > k)


class Lexicon(dict):
    """Word to code: 0 nothing, 1 second person, else 2 + the number of the lexicon entry; fills itself, and is bounded."""

    def __init__(self, entries: dict[str, float]):
        super().__init__()
        self.entries = entries
        self.number = {e: 2 + i for i, e in enumerate(entries)}
        self.weights = np.array([0.0, 0.0, *entries.values()])

    def __reduce__(self):
        return Lexicon, (self.entries,)

    def __missing__(self, word: str) -> int:
        found = [self.number[u] for u in units({word}) if u in self.number]
        code = max(found, key=self.weights.__getitem__) if found else int(word in SECOND_PERSON)
        if len(self) >= MEMO:
            self.clear()
        self[word] = code
        return code


N_FEATURES = 15


def features(text: str, lexicon: Lexicon) -> list[float]:
    raw = np.frombuffer(text.encode(), np.uint8)
    words = _WORD.findall(text.lower())
    n = max(len(words), 1)
    codes = np.fromiter(map(lexicon.__getitem__, words), np.int16, len(words))
    hits, you = np.flatnonzero(codes > 1), np.flatnonzero(codes == 1)
    weight = lexicon.weights[codes[hits]]
    distinct = len(np.unique(codes[hits]))
    counts = np.bincount(raw, minlength=128)
    hidden, mixed = 0, ()
    if counts[48:58].sum() + counts[[33, 35, 36, 42, 45, 46, 64, 95]].sum():
        mixed = _MIXED.findall(text)
        for m in mixed:
            flat = re.sub(r"[\W_]+|\d+", "", m.lower().translate(_PLAIN))
            hidden += lexicon[flat] > 1 and lexicon[m.lower()] < 2
    near = 0
    if len(hits) and len(you):
        at = np.searchsorted(you, hits)
        gap = np.minimum(np.abs(hits - you[np.minimum(at, len(you) - 1)]), np.abs(hits - you[np.maximum(at - 1, 0)]))
        near = int((gap <= NEAR).sum())
    letters = max(int(counts[65:91].sum() + counts[97:123].sum()), 1)
    return [
        float(len(hits)), len(hits) / n, float(distinct), distinct / n, float(weight.sum()), float(weight.max(initial=0.0)),
        float(near), near / n, len(you) / n,
        counts[65:91].sum() / letters, counts[33] / n, counts[[33, 34, 39, 44, 46, 58, 59, 63]].sum() / n,
        float(hidden), len(mixed) / n, float(np.log1p(len(words))),
    ]


def _labelled(docs: DataFrame, marks: DataFrame, sample: int) -> DataFrame:
    """At most ``sample`` training rows: doc_id, text, y. The ids are broadcast: their number is bounded."""
    known = marks.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    return docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")


def _presence(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {1: Counter()}
        for batch in batches:
            for text, y in zip(batch.column("text"), batch.column("y").to_pylist(), strict=True):
                if y == 1:  # what no toxic document has is no candidate
                    found[1].update(units(set(_WORD.findall(text.as_py().lower()))))
        words = list(found[1])
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([found[1][w] for w in words], pa.int64())], ["word", "n"])

    return rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("pos"))


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    totals = dict(rows.groupBy("y").count().collect())
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    least = max(LEAST_DOCS, LEAST_SHARE * n1)
    often = [(r["word"], r["pos"]) for r in _presence(rows).filter(F.col("pos") >= least).orderBy(F.desc("pos"), "word").collect()]
    wanted = {w for w, _ in often}

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text in batch.column("text"):
                found.update(wanted & units(set(_WORD.findall(text.as_py().lower()))))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["word", "n"])

    neg = {r["word"]: r["neg"] for r in rows.filter("y = 0").mapInArrow(clean, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("neg")).collect()}
    scored = []
    for word, pos in often:  # of a word and its beginnings that say the same, all may be entries
        p1, p0 = (pos + 0.5) / (n1 + 1), (neg.get(word, 0) + 0.5) / (n0 + 1)
        if p1 > 4 * p0 and word.rstrip("*") not in SECOND_PERSON:
            scored.append((-pos * np.log(p1 / p0), word, float(np.log(p1 / p0))))
    return {w: odds for _, w, odds in sorted(scored)[:LEXICON]}


class Model:
    def __init__(self, table: Lexicon, trees: Boosted, curve: Isotonic):
        self.table, self.trees, self.curve = table, trees, curve

    def score(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        x = np.array([features(t, self.table) for t in texts])
        raw = self.trees.raw(x)
        # The curve has flat parts; a share of a thousandth keeps the order of the trees inside them.
        return np.clip(0.999 * self.curve(raw) + 0.001 / (1 + np.exp(-raw)), 0, 1)


def fit(docs: DataFrame, marks: DataFrame, sample: int = SAMPLE) -> Model:
    rows = staged(_labelled(docs, marks, sample), "toxicity-sample")
    table = Lexicon(learn_lexicon(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t.as_py(), table) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "y", "x"])

    kind = dict(rows.dtypes)["doc_id"]
    got = rows.mapInArrow(run, f"doc_id {kind}, y int, x array<double>").withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4))).orderBy("doc_id").limit(sample).collect()
    x = np.array([r["x"] for r in got], float).reshape(-1, N_FEATURES)
    y, fold = np.array([r["y"] for r in got], float), np.array([r["fold"] for r in got])
    out = np.zeros(len(y))
    for k in range(4):  # the curve sees scores of trees that did not see the row
        if (fold == k).any() and (fold != k).any():
            out[fold == k] = Boosted.fit(x[fold != k], y[fold != k]).raw(x[fold == k])
    return Model(table, Boosted.fit(x, y), Isotonic(out, y) if len(y) else Isotonic(np.zeros(1), np.zeros(1)))


def scored(docs: DataFrame, model: Model, name: str = "tox_score") -> DataFrame:
    """The columns of ``docs`` and the score under ``name``, which must be free; the text is read whole, the other columns pass through."""
    if name in docs.columns:
        raise ValueError(f"the input already has a column {name}")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(texts), pa.float64())], [*names, name])

    from pyspark.sql.types import DoubleType, StructType

    return docs.mapInArrow(tidy(run), StructType(list(docs.schema.fields)).add(name, DoubleType()))


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = scored(docs.select("doc_id", "text"), fit(docs, labels(spark, sf_dir)))
    return out.select("doc_id", held_out().alias("held_out"), F.col("tox_score").alias("score"), (F.col("tox_score") >= 0.5).cast("int").alias("predicted"))
