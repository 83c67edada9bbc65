"""The training-data queries, and SQL for those that SQL can express."""

from __future__ import annotations

import functools
import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

from tidemark.llm import exact_dedup, idstore, language_model, media, mixing, near_dedup, packing, pii, quality, toxicity
from tidemark.llm.common import scratch_path

ROOT = Path(__file__).resolve().parents[2]
_shipped: set[str] = set()


#: Rows and bytes of a batch between Spark and its Python workers: whole texts are long, and two tasks share an executor.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def ship(spark: SparkSession) -> None:
    """Bound the batches, and send this package to the Python workers unless they find it by the search path or the folder they start in."""
    for name, value in BATCH.items():
        spark.conf.set(name, value)
    paths = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    app = spark.sparkContext.applicationId
    if app in _shipped or any(p and Path(p).resolve() == ROOT for p in paths):
        return
    jvm, shared = spark.sparkContext._jvm, f"{scratch_path(spark, 'package')}/tidemark.zip"
    with tempfile.TemporaryDirectory() as d:  # packed on the driver, then put where all machines see it
        inside = Path(d, "tree", "tidemark")
        shutil.copytree(ROOT / "tidemark", inside, ignore=shutil.ignore_patterns("__pycache__"))
        archive = shutil.make_archive(str(Path(d, "tidemark")), "zip", inside.parent)
        target = jvm.org.apache.hadoop.fs.Path(shared)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).copyFromLocalFile(jvm.org.apache.hadoop.fs.Path(f"file://{archive}"), target)
    spark.sparkContext.addPyFile(shared)
    _shipped.add(app)


def _ready(query):
    @functools.wraps(query)
    def run(spark, sf_dir):
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {
    name: _ready(query)
    for name, query in {
        "op1_pii": pii.op1_pii,
        "op2_quality": quality.op2_quality,
        "op3_media": media.op3_media,
        "op4_toxicity": toxicity.op4_toxicity,
        "op5_lm_score": language_model.op5_lm_score,
        "op6_exact_dedup": exact_dedup.op6_exact_dedup,
        "op7_token_ids": idstore.op7_token_ids,
        "op8_pack": packing.op8_pack,
        "op9_near_dedup": near_dedup.op9_near_dedup,
        "op10_mix_sources": mixing.op10_mix_sources,
    }.items()
}
SQL = {"op6_exact_dedup": exact_dedup.OP6_SQL, "op10_mix_sources": mixing.OP10_SQL}
