"""Scratch storage, normalisation constants and small helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the contracts: space, tab, newline, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]+"

_scratch: dict[str, list[str]] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The folder all machines share: ``spark.checkpoint.dir``; where it is unset, one of our own if all runs on this machine, else an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = jvm_dir.get() if jvm_dir.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh folder below the shared root, removed by :func:`sweep` or when the driver ends."""
    path = f"{checkpoint_root(spark)}/tidemark/{tag}-{uuid.uuid4().hex}"
    if not _scratch:
        atexit.register(_sweep_all)
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def staged(df: DataFrame, tag: str, light: bool = False) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read again: lineage ends here.

    A ``light`` table (a few numbers a row) goes to an eighth of the usual number of files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    if light:
        df = df.coalesce(max(4, shuffle_partitions(spark) // 8))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sweep(spark: SparkSession) -> None:
    """Delete every scratch folder of this application; results read from them must be stored first."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in _scratch.pop(spark.sparkContext.applicationId, []):
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def _sweep_all() -> None:
    spark = SparkSession.getActiveSession()
    if spark is None:
        return
    try:
        sweep(spark)
    except Exception:  # the JVM may be gone by now
        return


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def text_of(name: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fifth of documents that no model may learn from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_names(df: DataFrame, *stems: str) -> list[str]:
    """A column name for each stem that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    out = []
    for stem in stems:
        while stem.lower() in taken:
            stem += "_"
        taken.add(stem.lower())
        out.append(stem)
    return out


def tidy(run):
    """A batch function that gives its memory back when its task ends: Python workers live on, two to an executor."""

    def inner(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return inner


def give_back() -> None:
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)
