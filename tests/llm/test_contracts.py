"""Each registered query on the given tables: its columns, their types, and its rows."""

import os
from pathlib import Path

import pytest

from tidemark.llm import queries

SF = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables")

CONTRACT = {
    "op1_pii": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op2_quality": "doc_id bigint, held_out boolean, score double",
    "op3_media": "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string, print_times array<int>, print_codes array<int>",
    "op4_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op5_lm_score": "doc_id bigint, n_words bigint, log_prob double",
    "op6_exact_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op7_token_ids": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op8_pack": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op9_near_dedup": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op10_mix_sources": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
}


def test_all_are_registered():
    assert set(queries.QUERIES) == set(CONTRACT)


@pytest.mark.parametrize("name", CONTRACT)
def test_columns_and_rows(spark, name):
    got = queries.QUERIES[name](spark, str(SF))
    want = [tuple(c.split(" ")) for c in CONTRACT[name].split(", ")]
    assert got.dtypes[: len(want)] == want
    ids = sorted(r["doc_id"] for r in got.select("doc_id").collect())
    given = sorted(r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
    assert (sorted(set(ids)) == given) if name == "op8_pack" else ids == given
