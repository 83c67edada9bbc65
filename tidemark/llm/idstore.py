"""Token-id shards with a minimal perfect hash index.

Documents are dealt to ranges of ``doc_id`` and sorted inside each, every task writes shards of bounded size into the
shared folder, and a small manifest table (a row per shard) gives each shard the number of ids before it. A shard is two
files. ``.ids``: the magic ``TMID``, the width of an id in bytes, then the raw ids. ``.mph``: a JSON header, then the sorted
keys, the offsets, the levels of the hash with a rank every SAMPLE_BITS bits and, by hash slot, a stored fingerprint and the row
the key starts at. The hash is built level by level: keys that are alone in their bit stay, the others go to the next level, and a
key's slot is the rank of its bit, so a lookup is a constant number of small reads at computed places, and no key is compared.

Writing is idempotent: names depend on the range and shard alone, a file appears by an atomic rename, and a task that runs
again writes the same bytes. The folder can be any that ``pyarrow.fs`` opens and executors share.

Defined results: null text is empty (one end id); null ``doc_id`` sorts first, is stored, and is not found by key; ids of a type that is no
whole number are refused, since keys are hashed as 64-bit numbers; repeated
rows are stored one after the other in text order, and the key leads to the first; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tidemark.llm.common import documents, scratch_path, shuffle_partitions, staged, text_of, tidy

MAGIC = b"TMID"
SHARD_IDS = 8_000_000
SHARD_DOCS = 200_000
GAMMA = 1.6
#: Bits between two stored ranks.
SAMPLE_BITS = 512
LEVELS = 48


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        z = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) % (1 << 64))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


class PerfectHash:
    """Distinct 64-bit keys to 0 .. n-1; ``bits`` holds the bit arrays of all levels end to end."""

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.rank = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])
        self.base = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        sizes, levels, left = [], [], keys.astype(np.uint64)
        while len(left):
            if len(sizes) == LEVELS:
                raise ValueError("keys are not distinct")
            size = max(8, int(GAMMA * len(left)))
            at = (_mix(left, len(sizes) + 1) % np.uint64(size)).astype(np.int64)
            hits = np.bincount(at, minlength=size)
            levels.append(hits == 1)
            sizes.append(size)
            left = left[hits[at] > 1]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, bool))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 where no level holds it (a key that was never stored may get any slot)."""
        out, left, k = np.full(len(keys), -1, np.int64), np.arange(len(keys)), keys.astype(np.uint64)
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            at = self.base[level] + (_mix(k[left], level + 1) % np.uint64(size)).astype(np.int64)
            there = self.bits[at]
            out[left[there]] = self.rank[at[there]]
            left = left[~there]
        return out


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class ShardWriter:
    def __init__(self, uri: str, width: int):
        self.fs, self.path = _filesystem(uri)
        self.width, self.keys, self.lengths = width, [], []
        self.fs.create_dir(os.path.dirname(self.path), recursive=True)
        self.attempt = f".{TaskContext.get().taskAttemptId() if TaskContext.get() else 0}.tmp"
        self.out = self.fs.open_output_stream(self.path + ".ids" + self.attempt, buffer_size=1 << 20)
        self.out.write(MAGIC + struct.pack("<I", width))
        self.ids = 0

    def add(self, key: int | None, packed: bytes) -> None:
        ids = np.frombuffer(packed, "<u4")
        self.out.write(ids.astype(f"<u{self.width}").tobytes())
        self.keys.append(key)
        self.lengths.append(len(ids))
        self.ids += len(ids)

    def close(self) -> None:
        self.out.close()
        known = np.array([k is not None for k in self.keys], bool)
        keys = np.array([k or 0 for k in self.keys], np.int64)
        distinct, first = np.unique(keys[known], return_index=True)
        mph = PerfectHash.build(distinct)
        slot = mph.slots(distinct)
        prints, rows = np.zeros(len(distinct), np.uint32), np.zeros(len(distinct), np.uint32)
        prints[slot] = (_mix(distinct, 99) >> np.uint64(32)).astype(np.uint32)
        rows[slot] = np.flatnonzero(known)[first]
        offsets = np.concatenate([[0], np.cumsum(self.lengths, dtype=np.int64)])
        head = json.dumps({"docs": len(keys), "keys": len(distinct), "sizes": mph.sizes, "width": self.width}).encode()
        ranks = mph.rank[:-1:SAMPLE_BITS]
        parts = [struct.pack("<I", len(head)), head, keys.astype("<i8").tobytes(), known.astype("u1").tobytes(), offsets.astype("<i8").tobytes(), np.packbits(mph.bits).tobytes(), ranks.astype("<u4").tobytes(), prints.astype("<u4").tobytes(), rows.astype("<u4").tobytes()]
        with self.fs.open_output_stream(self.path + ".mph" + self.attempt) as f:
            f.write(b"".join(parts))
        for kind in (".ids", ".mph"):
            self.fs.move(self.path + kind + self.attempt, self.path + kind)


def _sections(head: dict, at: int) -> dict[str, tuple[int, str, int]]:
    """Where each part of an index file is: (offset, kind, count)."""
    docs, keys, bits = head["docs"], head["keys"], sum(head["sizes"])
    out = {}
    for name, kind, count in (("keys", "<i8", docs), ("known", "u1", docs), ("offsets", "<i8", docs + 1), ("bits", "u1", -(-bits // 8)), ("ranks", "<u4", -(-bits // SAMPLE_BITS)), ("prints", "<u4", keys), ("rows", "<u4", keys)):
        out[name] = (at, kind, count)
        at += np.dtype(kind).itemsize * count
    return out


class Shard:
    """A written shard. ``get`` finds one key by a constant number of small positioned reads; ``find`` reads the index for many."""

    def __init__(self, uri: str):
        self.fs, path = _filesystem(uri)
        self.index, self.payload = self.fs.open_input_file(path + ".mph"), self.fs.open_input_file(path + ".ids")
        (n,) = struct.unpack("<I", self.index.read_at(4, 0))
        self.head = json.loads(self.index.read_at(n, 4))
        self.width, self.sections = self.head["width"], _sections(self.head, 4 + n)
        if self.payload.read_at(4, 0) != MAGIC:
            raise ValueError(f"{path}.ids is not an id shard")

    def _read(self, name: str, first: int = 0, count: int | None = None) -> np.ndarray:
        at, kind, total = self.sections[name]
        size = np.dtype(kind).itemsize
        return np.frombuffer(self.index.read_at(size * (total if count is None else min(count, total - first)), at + size * first), kind)

    # The parts that finding all keys at once needs, read when asked for.
    keys = cached_property(lambda self: self._read("keys"))
    known = cached_property(lambda self: self._read("known").astype(bool))
    offsets = cached_property(lambda self: self._read("offsets"))
    mph = cached_property(lambda self: PerfectHash(self.head["sizes"], np.unpackbits(self._read("bits"), count=sum(self.head["sizes"])).astype(bool)))
    prints = cached_property(lambda self: self._read("prints"))
    rows = cached_property(lambda self: self._read("rows"))

    def _slot(self, key: np.ndarray) -> int | None:
        base = 0
        for level, size in enumerate(self.head["sizes"]):  # a key leaves each level with a chance that does not depend on their number
            bit = base + int(_mix(key, level + 1)[0] % np.uint64(size))
            if self._read("bits", bit // 8, 1)[0] >> (7 - bit % 8) & 1:
                block = bit // SAMPLE_BITS
                before = np.unpackbits(self._read("bits", block * SAMPLE_BITS // 8, SAMPLE_BITS // 8))[: bit - block * SAMPLE_BITS]
                return int(self._read("ranks", block, 1)[0]) + int(before.sum())
            base += size
        return None

    def row_of(self, key: int) -> int | None:
        """The first row of a key; nothing for one whose fingerprint is not the stored one."""
        keys = np.array([key], np.int64)
        slot = self._slot(keys)
        if slot is None or self._read("prints", slot, 1)[0] != (_mix(keys, 99)[0] >> np.uint64(32)).astype(np.uint32):
            return None
        return int(self._read("rows", slot, 1)[0])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The first row of each key, -1 for keys whose fingerprint is not the stored one."""
        slot = self.mph.slots(keys)
        hit = slot >= 0
        hit[hit] = self.prints[slot[hit]] == (_mix(keys[hit], 99) >> np.uint64(32)).astype(np.uint32)
        return np.where(hit, self.rows[slot * hit].astype(np.int64) if len(self.rows) else -1, -1)

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids of rows first .. last-1, end to end, read from the payload."""
        a, b = int(self._read("offsets", first, 1)[0]), int(self._read("offsets", last, 1)[0])
        return np.frombuffer(self.payload.read_at((b - a) * self.width, 8 + a * self.width), f"<u{self.width}").astype("<u4")

    def get(self, key: int) -> np.ndarray | None:
        row = self.row_of(key)
        return None if row is None else self.ids(row, row + 1)


def write_store(docs: DataFrame, tokenizer_path: str, end_id: int, space_joins: bool = True, root: str | None = None) -> DataFrame:
    """Write the shards; returns the stored manifest: part, shard, uri, n_docs, n_ids, first_key, last_key, ids_before.

    Keys ascend over the shards, so a shard's first and last known key (null without any) lead :class:`Store` straight to it.
    """
    spark = docs.sparkSession
    if not isinstance(docs.schema["doc_id"].dataType, IntegralType):
        raise TypeError(f"doc_id must be a whole number, not {dict(docs.dtypes)['doc_id']}")
    root = root or scratch_path(spark, "ids")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tidemark.llm.encoding import encoder

        enc, part, shard, out, done = encoder(tokenizer_path, space_joins), TaskContext.get().partitionId(), 0, None, []
        width = 2 if enc.vocabulary <= 1 << 16 else 4
        end = struct.pack("<I", end_id)

        def close() -> None:
            nonlocal out, shard
            out.close()
            known = [k for k in out.keys if k is not None]
            done.append((part, shard, f"{root}/part-{part:06d}-{shard:05d}", len(out.keys), out.ids, min(known, default=None), max(known, default=None)))
            out, shard = None, shard + 1

        for batch in batches:
            for key, ids in zip(batch.column("doc_id").to_pylist(), enc.packed_all(batch.column("text").to_pylist()), strict=True):
                out = out or ShardWriter(f"{root}/part-{part:06d}-{shard:05d}", width)
                out.add(key, ids + end)
                if out.ids >= SHARD_IDS or len(out.keys) >= SHARD_DOCS:
                    close()
        if out:
            close()
        names = ["part", "shard", "uri", "n_docs", "n_ids", "first_key", "last_key"]
        cols = list(zip(*done, strict=True)) or [[]] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()], strict=True)], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    dealt = rows.repartitionByRange(shuffle_partitions(spark), F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    manifest = staged(dealt.mapInArrow(tidy(write), "part int, shard int, uri string, n_docs bigint, n_ids bigint, first_key bigint, last_key bigint"), "ids-manifest")
    # A row per shard: the only thing summed in one place, about a millionth of the payload.
    before = F.sum("n_ids").over(Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1))
    return manifest.withColumn("ids_before", F.coalesce(before, F.lit(0)))


class Store:
    """Keyed access over all shards: the manifest's key ranges, a row per shard, name the shard, and its hash the row."""

    def __init__(self, manifest: DataFrame):
        rows = manifest.filter("first_key IS NOT NULL").select("first_key", "last_key", "uri").orderBy("last_key", "part", "shard").collect()
        self.rows, self.last = rows, [r["last_key"] for r in rows]

    def get(self, key: int) -> np.ndarray | None:
        """The ids of the first row with this key; only one shard is opened."""
        k = bisect_left(self.last, key)
        return Shard(self.rows[k]["uri"]).get(key) if k < len(self.rows) and self.rows[k]["first_key"] <= key else None


def read_store(manifest: DataFrame) -> DataFrame:
    """Every document, found by key in its shard: doc_id, start, n_tokens, ids_crc32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["uri"])
                at = np.arange(len(shard.keys))
                found = shard.find(shard.keys[shard.known])  # repeated keys lead to the first of their rows
                repeat = np.concatenate([[False], (shard.keys[1:] == shard.keys[:-1]) & shard.known[1:] & shard.known[:-1]]) if len(at) else np.zeros(0, bool)
                at[shard.known & ~repeat] = found[~repeat[shard.known]]
                ids = shard.ids(0, len(at))
                crc = [zlib.crc32(ids[shard.offsets[i] : shard.offsets[i + 1]].tobytes()) for i in at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.keys, pa.int64(), mask=~shard.known), pa.array(row["ids_before"] + shard.offsets[at]), pa.array(shard.offsets[at + 1] - shard.offsets[at]), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return manifest.repartition(shuffle_partitions(manifest.sparkSession), "part", "shard").mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op7_token_ids(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return read_store(write_store(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), end_id=0))
