import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import idstore, packing
from tidemark.llm.encoding import PieceEncoder

BYTE, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
BITS = ["a", "B", "é", " ", "  ", "\n", ".", ",", "'s", "1", "2²", "\t", "\x1c", " ", "́", "Σ", "ß", "İ", "_", "!!", "中", "<|endoftext|>", "\r\n", "😀", "\x01", "ll", "@"]
ROWS = [(3, "The cat, the hat.\nA dog"), (1, None), (2, ""), (2, "again"), (2, "again"), (None, "null key"), (9, "word " * 9000), (-5, "<|endoftext|> x")]


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, start int, uri string").repartition(parts)


def ids_of(path, text, end):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


@pytest.mark.parametrize("path, joins", [(BYTE, True), (WORDS, False)])
def test_pieces_encode_like_whole_texts(path, joins):
    rnd, enc = random.Random(5), PieceEncoder(path, joins)
    texts = ["".join(rnd.choice(BITS) for _ in range(rnd.randrange(14))) for _ in range(8000)]
    texts += [" ".join("".join(rnd.choice("abcdeéß") for _ in range(rnd.randint(1, 9))) + rnd.choice(["", "", ",", ".", "!!", ".\nX"]) for _ in range(30)) for _ in range(300)]
    assert list(enc.packed_all(texts)) == [enc.whole(t) for t in texts]


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(-(1 << 60), 1 << 60, 5000))
    mph = idstore.PerfectHash.build(keys)
    assert sorted(mph.slots(keys).tolist()) == list(range(len(keys)))
    assert len(idstore.PerfectHash.build(keys[:0]).slots(keys[:3])) == 3


def test_store_round_trip(spark, monkeypatch):
    monkeypatch.setattr(idstore, "SHARD_DOCS", 2)
    manifest = idstore.write_store(frame(spark, ROWS), BYTE, 0)
    got = sorted(map(tuple, idstore.read_store(manifest).collect()), key=lambda r: r[1])
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at = 0
    for row, (key, text) in zip(got, order, strict=True):
        ids = ids_of(BYTE, text, 0)
        assert row == (key, at, len(ids), crc(ids))
        at += len(ids)
    for m in manifest.collect():
        shard = idstore.Shard(m["uri"])
        for k in set(shard.keys[shard.known].tolist()):
            text = sorted(t or "" for i, t in ROWS if i == k)[0] if k != 2 or shard.keys[0] != 2 else None
            assert shard.get(k) is not None and (text is None or shard.get(k).tolist() == ids_of(BYTE, text, 0))
        assert shard.get(123456789) is None
    assert idstore.read_store(idstore.write_store(frame(spark, []), BYTE, 0)).count() == 0


def test_packing_covers_every_id_once(spark):
    rows = [(i, " ".join(f"w{(i * 7 + k) % 90}" for k in range(20 + 37 * (i % 40)))) for i in range(120)] + ROWS
    pieces = [r.asDict() for r in packing.pack(frame(spark, rows, 1), WORDS, with_ids=True).collect()]
    sequences = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append(p)
        assert crc(np.frombuffer(p["ids"], "<u4").tolist()) == p["ids_crc32"] and len(p["ids"]) == 4 * p["length"]
    sizes = []
    for s in sequences.values():
        at = 0
        for p in sorted(s, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        sizes.append(at)
    assert max(sizes) <= 2048 and all(n & (n - 1) == 0 for n in sizes)
    for key in {i for i, _ in rows if i != 2}:
        (text,) = [t for i, t in rows if i == key][:1]
        if sum(i == key for i, _ in rows) > 1:
            continue
        mine = sorted((p for p in pieces if p["doc_id"] == key), key=lambda p: p["start"])
        assert np.frombuffer(b"".join(p["ids"] for p in mine), "<u4").tolist() == ids_of(WORDS, text, 1)
    assert packing.pack(frame(spark, []), WORDS).count() == 0


def test_neighbours_share_words(spark):
    rows = [(i, " ".join(f"{'ab'[i % 2]}{k % 17}" for k in range(300))) for i in range(40)]
    together = {}
    for p in packing.pack(frame(spark, rows, 1), WORDS).collect():
        together.setdefault(p["sequence_id"], set()).add(p["doc_id"] % 2)
    assert sum(len(s) == 1 for s in together.values()) > 0.7 * len(together)


def test_store_finds_a_key_in_one_shard(spark, monkeypatch):
    monkeypatch.setattr(idstore, "SHARD_DOCS", 2)
    manifest = idstore.write_store(frame(spark, ROWS), BYTE, 0)
    store, opened, shard = idstore.Store(manifest), [], idstore.Shard
    assert manifest.count() > 2
    monkeypatch.setattr(idstore, "Shard", lambda uri: opened.append(uri) or shard(uri))
    for key, text in ((3, ROWS[0][1]), (1, None), (9, ROWS[6][1]), (-5, ROWS[7][1]), (2, "")):
        opened.clear()
        assert store.get(key).tolist() == ids_of(BYTE, text, 0) and len(opened) == 1
    assert store.get(-6) is None and store.get(10) is None and store.get(4) is None
