"""Lexical retrieval packing.

Each task cuts its documents into shards of bounded size and builds a BM25 inverted index over whole documents of a shard.
A document fills full windows alone; what is left of it is a tail. The longest unused tail seeds a window, the
index ranks unused neighbours by BM25 against the seed's most telling terms, and they fill the window greedily, the last one
being cut to fit; its rest stays unused. Neighbours that share none of these terms score 0 and follow in order of input. A shard's last, unfilled window passes on to the next shard of the
task; at the end of a task it is cut into sequences whose lengths are powers of two, which need no padding. There is
no shuffle: rows of any key or source are spread as the input files spread them, and a lost task is made again from its split.

Defined results: null text is empty, so the document is its end id alone; null ``doc_id`` and repeated rows are packed
row by row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import documents, text_of, tidy

WINDOW = 2048
SHARD_IDS = 3_000_000
QUERY_TERMS = 16
K1, B = 1.2, 0.75


def _counted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids and how often each is there."""
    if len(ids) and ids.max() < 1 << 16:  # 16-bit keys sort by radix
        ids = ids.astype(np.uint16)
    ids = np.sort(ids, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    return ids[first], np.diff(np.append(first, len(ids)))


class Index:
    """BM25 postings of one shard, by term."""

    def __init__(self, docs: list[np.ndarray]):
        found = [_counted(d) for d in docs]
        self.n = len(docs)
        sizes = np.array([len(d) for d in docs], np.float32)
        owner = np.repeat(np.arange(self.n, dtype=np.int32), [len(t) for t, _ in found])
        terms = np.concatenate([t for t, _ in found]).astype(np.uint16 if max(int(t[-1]) for t, _ in found) < 1 << 16 else np.uint32)
        tf = np.concatenate([c for _, c in found]).astype(np.float32)
        order = np.argsort(terms, kind="stable")
        self.owner = owner[order]
        df = np.bincount(terms)
        self.first = np.concatenate([[0], np.cumsum(df)])
        self.idf = np.log1p((self.n - df + 0.5) / (df + 0.5)).astype(np.float32)
        self.df = df
        norm = (K1 * (1 - B + B * sizes / max(sizes.mean(), 1)))[self.owner]
        weight = tf[order]
        self.weight = self.idf[terms[order]] * weight * (K1 + 1) / (weight + norm)
        self.query = []
        for t, c in found:  # a seed asks by its heaviest terms that others have too
            t, c = (t[k], c[k]) if (k := df[t] > 1).any() else (t[:0], c[:0])
            if len(t) > QUERY_TERMS:
                t = t[np.argpartition(-(self.idf[t] * np.minimum(c, 8)), QUERY_TERMS)[:QUERY_TERMS]]
            self.query.append(t)

    def scores(self, seed: int) -> np.ndarray:
        spans = [slice(self.first[t], self.first[t + 1]) for t in self.query[seed]]
        if not spans:
            return np.zeros(self.n)
        return np.bincount(np.concatenate([self.owner[s] for s in spans]), np.concatenate([self.weight[s] for s in spans]), self.n)


class Packer:
    """Rows: (doc row, start, length, sequence, offset); docs are (key, packed ids)."""

    def __init__(self, window: int, first_sequence: int):
        self.window, self.sequence, self.open = window, first_sequence, []

    def _emit(self, pieces: list[tuple]) -> list[tuple]:
        rows, at = [], 0
        for key, ids, total, start, length in pieces:
            rows.append((key, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), total, self.sequence, at, ids[4 * start : 4 * (start + length)]))
            at += length
        self.sequence += 1
        return rows

    def shard(self, docs: list[tuple]) -> Iterator[tuple]:
        w, n = self.window, len(docs)
        total = np.array([len(ids) // 4 for _, ids in docs], np.int64)
        start = total // w * w
        for i in np.flatnonzero(start):
            key, ids = docs[i]
            for a in range(0, int(start[i]), w):
                yield from self._emit([(key, ids, int(total[i]), a, w)])
        left = total - start
        unused = left > 0
        if not unused.any():
            return
        index = Index([np.frombuffer(ids, "<u4") for _, ids in docs])
        order, pos = np.argsort(-left, kind="stable"), 0
        filled = sum(p[4] for p in self.open)
        while True:
            while pos < n and not unused[order[pos]]:
                pos += 1
            if pos == n:
                return
            pieces, scores, seed = self.open, None, int(order[pos])
            nxt = seed
            while True:
                take = min(int(left[nxt]), w - filled)
                pieces.append((docs[nxt][0], docs[nxt][1], int(total[nxt]), int(start[nxt]), take))
                start[nxt] += take
                left[nxt] -= take
                filled += take
                unused[nxt] = left[nxt] > 0
                if filled == w:
                    break
                if scores is None:
                    scores = index.scores(seed)
                ranked = np.where(unused, scores, -1.0)
                nxt = int(np.argmax(ranked))
                if ranked[nxt] < 0:
                    break
            if filled < w:  # the shard is used up
                self.open = pieces
                return
            yield from self._emit(pieces)
            self.open, filled = [], 0

    def finish(self) -> Iterator[tuple]:
        """What is left, cut at powers of two."""
        pieces, self.open = self.open, []
        room, now = 0, []
        rest = sum(p[4] for p in pieces)
        for key, ids, total, start, length in pieces:
            while length:
                room = room or 1 << (rest.bit_length() - 1)
                take = min(room, length)
                now.append((key, ids, total, start, take))
                start, length, room, rest = start + take, length - take, room - take, rest - take
                if not room:
                    yield from self._emit(now)
                    now = []


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and on demand its ids as bytes."""
    if window & (window - 1):
        raise ValueError("the window is a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tidemark.llm.encoding import encoder

        enc, end = encoder(tokenizer_path, False), struct.pack("<I", end_id)
        packer, docs, held = Packer(window, TaskContext.get().partitionId() << 40), [], 0

        def table(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 8
            kinds = [key_type, *[pa.int64()] * 6, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in list(zip(cols, kinds, strict=True))[: 7 + with_ids]], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"][: 7 + with_ids])

        for batch in batches:
            for key, ids in zip(batch.column("doc_id").to_pylist(), enc.packed_all(batch.column("text").to_pylist()), strict=True):
                docs.append((key, ids + end))
                held += len(docs[-1][1]) // 4
                if held >= SHARD_IDS:
                    yield table(list(packer.shard(docs)))
                    docs, held = [], 0
        yield table(list(packer.shard(docs)) if docs else [])
        yield table(list(packer.finish()))

    key_type = to_arrow_type(docs.schema["doc_id"].dataType)
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint" + ", ids binary" * with_ids
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(tidy(run), schema)


def op8_pack(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
