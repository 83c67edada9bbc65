"""Document quality by co-training two views.

The text view sees what is written (lengths, repetition, symbols, case, compressibility); the metadata view sees what is
recorded beside it (lang, source, n_chars and which of them are missing). Each view is an additive logistic model over
binned features. Both start from labelled rows; in each round every unlabelled document that one view is confident of
becomes a pseudo-label for the other view, whose next Newton step sums over the whole table: the tasks send only the gradient and the
Hessian, so the driver's share is fixed by the number of features. Last, Platt scaling calibrates the views on labelled
rows kept aside, a logistic combination, fitted on others kept aside, joins them, and all documents are scored.

At most ``SAMPLE`` labelled rows are used, the first by a hash of their id, none of the held-out fifth.

Defined results: null text is empty, null metadata is a value of its own; null labels or ids teach nothing; of repeated labels the
highest counts; repeated rows are scored alike; without labels of both kinds every score is the mean label (0.5 without
labels); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents, held_out, labels, staged, text_of

SAMPLE = 20_000
ROUNDS = 3
#: A view's calibrated probability from which it hands a pseudo-label on: this, or one minus this.
CONFIDENT = 0.97
BINS, RIDGE = 8, 1.0
LANGS, SOURCES = 16, 64
N_TEXT = 16


def text_view(text: str) -> list[float]:
    raw = text.encode()
    words = text.split()
    n, size = max(len(words), 1), max(len(raw), 1)
    byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower = int(byte[65:91].sum()), int(byte[97:123].sum())
    seen = Counter(words)
    lines = text.split("\n")
    line_count = Counter(lines)
    return [
        float(np.log1p(len(words))), len(raw) / n, len(seen) / n, max(seen.values(), default=0) / n,
        sum(map(eq, words, words[1:])) / n, byte[[35, 36, 37, 38, 42, 94, 126]].sum() / n, byte[33] / n, byte[124] / n,
        upper / max(upper + lower, 1), byte[48:58].sum() / size, byte[46] / n, byte[128:].sum() / size,
        max(line_count.values()) / len(lines), len(line_count) / len(lines), float(np.log1p(size / len(lines))),
        len(zlib.compress(raw, 1)) / size,
    ]


def meta_view(lang: str | None, source: str | None, n_chars: int | None) -> list[int]:
    """Active indicators: lang, source, length class."""
    size = 0 if n_chars is None else 1 + min(22, max(int(n_chars), 0).bit_length())
    return [
        0 if lang is None else 1 + zlib.crc32(lang.encode()) % (LANGS - 1),
        LANGS + (0 if source is None else 1 + zlib.crc32(source.encode()) % (SOURCES - 1)),
        LANGS + SOURCES + size,
    ]


N_META = LANGS + SOURCES + 24


def _one_hot(active: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(active), width + 1), np.float64)
    out[:, width] = 1
    out[np.arange(len(active))[:, None], active] = 1
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _sums(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = _sigmoid(x @ w)
    return x.T @ (y - p), (x * (p * (1 - p))[:, None]).T @ x


def _step(w: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    ridge = np.full(len(w), RIDGE)
    ridge[-1] = 1e-6
    return w + np.linalg.solve(h + np.diag(ridge + 1e-9), g - ridge * w)


def _newton(x: np.ndarray, y: np.ndarray, steps: int = 8) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        w = _step(w, *_sums(x, y, w))
    return w


class Views:
    """Both views' weights, their calibration (slope, offset) and the combination."""

    def __init__(self, edges: list[np.ndarray], prior: float):
        self.edges, self.prior = edges, prior
        self.w = [np.zeros(N_TEXT * BINS + 1), np.zeros(N_META + 1)]
        self.platt = [np.array([1.0, 0.0])] * 2
        self.joint: np.ndarray | None = None

    def design(self, xt: np.ndarray, xm: np.ndarray) -> list[np.ndarray]:
        at = np.stack([np.searchsorted(e, c) for c, e in zip(xt.T, self.edges, strict=True)], axis=1) + np.arange(N_TEXT) * BINS
        return [_one_hot(at, N_TEXT * BINS), _one_hot(xm, N_META)]

    def logits(self, x: list[np.ndarray]) -> list[np.ndarray]:
        return [(m @ w) * p[0] + p[1] for m, w, p in zip(x, self.w, self.platt, strict=True)]

    def calibrate(self, x: list[np.ndarray], y: np.ndarray) -> None:
        self.platt = [np.array([1.0, 0.0])] * 2
        if 0 < y.mean() < 1:
            fits = [_newton(np.stack([z, np.ones(len(z))], axis=1), y, 12) for z in self.logits(x)]
            self.platt = [f if f[0] > 0 else np.array([0.0, f[1]]) for f in fits]

    def combine(self, x: list[np.ndarray], y: np.ndarray) -> None:
        if 0 < y.mean() < 1:
            self.joint = _newton(np.stack([*self.logits(x), np.ones(len(y))], axis=1), y, 12)

    def probability(self, x: list[np.ndarray]) -> list[np.ndarray]:
        z = self.logits(x)
        if self.joint is None:
            return [np.full(len(z[0]), self.prior)] * 3
        return [_sigmoid(z[0]), _sigmoid(z[1]), _sigmoid(np.stack([*z, np.ones(len(z[0]))], axis=1) @ self.joint)]


def _matrices(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("xt").flatten().to_numpy().reshape(-1, N_TEXT), batch.column("xm").flatten().to_numpy().reshape(-1, 3)


def view_table(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            xt = [text_view(t.as_py()) for t in b.column("text")]
            xm = [meta_view(*r) for r in zip(*(b.column(c).to_pylist() for c in ("lang", "source", "n_chars")), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(xt, pa.list_(pa.float64())), pa.array(xm, pa.list_(pa.int32()))], ["doc_id", "xt", "xm"])

    rows = docs.select("doc_id", text_of().alias("text"), F.col("lang").cast("string"), F.col("source").cast("string"), F.col("n_chars").cast("bigint"))
    return staged(rows.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, xt array<double>, xm array<int>"), "quality-views")


def _pseudo_round(table: DataFrame, views: Views) -> tuple[list[np.ndarray], list[np.ndarray], list[float]]:
    """Over all rows: per view gradient, Hessian and number of pseudo-labels that the other view gave."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [None, None]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = views.design(*_matrices(batch))
            p = [_sigmoid(z) for z in views.logits(x)]
            for me, other in ((0, 1), (1, 0)):
                sure = (p[other] >= CONFIDENT) | (p[other] <= 1 - CONFIDENT)
                g, h = _sums(x[me][sure], (p[other][sure] >= 0.5).astype(float), views.w[me])
                flat = np.concatenate([g, h.ravel(), [sure.sum()]])
                total[me] = flat if total[me] is None else total[me] + flat
        for me in (0, 1):
            if total[me] is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(total[me]), me), pa.int32()), pa.array(np.arange(len(total[me])), pa.int32()), pa.array(total[me])], ["view", "k", "v"])

    got = table.select("xt", "xm").mapInArrow(run, "view int, k int, v double").groupBy("view", "k").agg(F.sum("v").alias("v")).toPandas()
    gs, hs, ns = [], [], []
    for me in (0, 1):
        d = len(views.w[me])
        flat = np.zeros(d + d * d + 1)
        mine = got[got["view"] == me]
        flat[mine["k"].to_numpy()] = mine["v"].to_numpy()
        gs.append(flat[:d])
        hs.append(flat[d:-1].reshape(d, d))
        ns.append(float(flat[-1]))
    return gs, hs, ns


def fit(table: DataFrame, marks: DataFrame, sample: int = SAMPLE) -> Views:
    known = marks.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("quality").cast("int").alias("y"))
    chosen = staged(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "quality-sample")
    rows = table.join(F.broadcast(chosen), "doc_id").orderBy("doc_id", "xt").limit(sample).toPandas()
    y = rows["y"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        return Views([np.zeros(0)] * N_TEXT, float(y.mean()) if len(y) else 0.5)
    xt, xm = np.stack(rows["xt"]).astype(float), np.stack(rows["xm"]).astype(int)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in xt.T]
    views = Views(edges, float(y.mean()))
    fifth = np.array([zlib.crc32(f"{i}:aside".encode()) % 5 for i in rows["doc_id"]])
    learn, tune, join = fifth > 1, fifth == 0, fifth == 1
    if any(len(set(y[part].tolist())) < 2 for part in (learn, tune, join)):  # too few labels to keep any aside
        learn = tune = join = np.ones(len(y), bool)
    x = views.design(xt, xm)
    x_learn, x_tune, x_join = ([m[part] for m in x] for part in (learn, tune, join))
    views.w = [_newton(m, y[learn]) for m in x_learn]
    views.calibrate(x_tune, y[tune])
    unlabelled = table.join(F.broadcast(chosen), "doc_id", "left_anti")
    for _ in range(ROUNDS):
        gs, hs, ns = _pseudo_round(unlabelled, views)
        for me in (0, 1):
            g, h = _sums(x_learn[me], y[learn], views.w[me])
            share = min(1.0, learn.sum() / ns[me]) if ns[me] else 0.0  # all pseudo-labels together weigh no more than the labels
            views.w[me] = _step(views.w[me], g + share * gs[me], h + share * hs[me])
        views.calibrate(x_tune, y[tune])
    views.combine(x_join, y[join])
    return views


def score(table: DataFrame, views: Views) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = views.probability(views.design(*_matrices(b)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(v, pa.float64()) for v in p]], ["doc_id", "text_score", "meta_score", "score"])

    return table.mapInArrow(run, f"doc_id {dict(table.dtypes)['doc_id']}, text_score double, meta_score double, score double")


def op2_quality(spark, sf_dir: str) -> DataFrame:
    table = view_table(documents(spark, sf_dir))
    out = score(table, fit(table, labels(spark, sf_dir)))
    return out.select("doc_id", held_out().alias("held_out"), "score", "text_score", "meta_score", (F.col("score") >= 0.5).cast("int").alias("predicted"), (F.col("score") >= 0.5).alias("kept"))
