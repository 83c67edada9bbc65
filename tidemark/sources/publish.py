"""Datasets with manifests: canonical bytes, staged publication, verified reads.

A publication becomes visible by its manifest, which is renamed into place last. Reading starts from the manifest and refuses
files it does not list or whose digest differs. Rows are written by executors; the driver moves files and strings their bytes together.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import gzip
import hashlib
import json
import os
import shutil
from collections.abc import Iterable, Mapping
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import RefusalError

SCHEMA_VERSION = "1.0"
MANIFEST = "manifest.json"


def canonical_json(df: DataFrame) -> DataFrame:
    """One column ``value``: a JSON object per row, keys sorted, nulls written."""
    return df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("value"))


def text_file(lines: DataFrame, target: Path, compress: bool = False, head: Path | None = None) -> int:
    """Ordered text rows (value) as one file, after the lines of ``head``; the number of rows. Compressed bytes carry no time.

    Executors write the parts; here their bytes are only strung together, block by block.
    """
    seen = Observation("rows")
    target.parent.mkdir(parents=True, exist_ok=True)
    parts = target.with_name(f".{target.name}.parts")
    temporary = target.with_name(f".{target.name}.tmp")
    try:
        lines.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").text(parts.as_uri())
        with temporary.open("wb") as raw, gzip.GzipFile(filename="", fileobj=raw, mode="wb", mtime=0) if compress else contextlib.nullcontext(raw) as out:
            if head is not None and head.exists():
                _copy_lines(head, out)
            for part in sorted(parts.glob("part-*")):
                with part.open("rb") as f:
                    shutil.copyfileobj(f, out, 1 << 20)
        os.replace(temporary, target)
    finally:
        shutil.rmtree(parts, ignore_errors=True)
        temporary.unlink(missing_ok=True)
    return int(seen.get["n"])


def _copy_lines(path: Path, out) -> None:
    """The lines of a text file with line feeds only, the last one included."""
    with path.open(encoding="utf-8", newline=None) as f:
        for line in f:
            out.write((line.removesuffix("\n") + "\n").encode())


def json_file(df: DataFrame, order: list, target: Path, compress: bool = False) -> int:
    """The rows as JSON lines in a total order, and their number."""
    return text_file(canonical_json(df.orderBy(*order)), target, compress)


def sha256_of(path: Path) -> str:
    digest = hashlib.sha256()
    with path.open("rb") as f:
        while block := f.read(1 << 20):
            digest.update(block)
    return digest.hexdigest()


def write_atomically(path: Path, data: bytes) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    temporary = path.with_name(f".{path.name}.tmp")
    temporary.write_bytes(data)
    os.replace(temporary, path)


def _files(folder: Path) -> dict[str, Path]:
    """What a folder holds by name: files, and the parts of tables (folders named .parquet). Hidden ones are left out."""
    out = {}
    for p in sorted(folder.iterdir()):
        if p.name == MANIFEST or p.name.startswith("."):
            continue
        if p.is_file():
            out[p.name] = p
        elif p.suffix == ".parquet":
            out |= {f"{p.name}/{q.name}": q for q in sorted(p.glob("part-*"))}
    return out


def build_manifest(files: Mapping[str, Path], source_urls: Iterable[str], license_note: str, rows: Mapping[str, int] | None = None, extra: Mapping | None = None, generated_at: str | None = None) -> dict:
    """Files by name with digest, size and, where known, rows."""
    rows = rows or {}
    entries = [{"name": name, "sha256": sha256_of(p), "bytes": p.stat().st_size} | ({"rows": rows[name]} if name in rows else {}) for name, p in sorted(files.items())]
    now = generated_at or dt.datetime.now(dt.timezone.utc).isoformat(timespec="seconds")
    return {"schema_version": SCHEMA_VERSION, "generated_at_utc": now, "source_urls": sorted(source_urls), "license_note": license_note, "files": entries} | dict(extra or {})


def _write_manifest(folder: Path, made: dict) -> dict:
    write_atomically(folder / MANIFEST, (json.dumps(made, indent=2, sort_keys=True) + "\n").encode())
    return made


def write_manifest(folder: Path, **what) -> dict:
    return _write_manifest(folder, build_manifest(_files(folder), **what))


def read_manifest(folder: Path) -> dict:
    path = folder / MANIFEST
    if not path.is_file():
        raise RefusalError(f"{folder} has no manifest")
    found = json.loads(path.read_text())
    if found.get("schema_version") != SCHEMA_VERSION:
        raise RefusalError(f"{path} has schema version {found.get('schema_version')!r}, not {SCHEMA_VERSION!r}")
    return found


def generated_at(folder: Path) -> dt.datetime:
    text = read_manifest(folder).get("generated_at_utc")
    try:
        when = dt.datetime.fromisoformat(text)
    except (TypeError, ValueError) as e:
        raise RefusalError(f"{folder} has no readable time of generation: {text!r}") from e
    if when.tzinfo is None:
        raise RefusalError(f"{folder} has a time of generation without a zone: {text!r}")
    return when.astimezone(dt.timezone.utc)


def publish(folder: Path, staged: Mapping[str, bytes | Path], source_urls: Iterable[str], license_note: str, rows: Mapping[str, int] | None = None, extra: Mapping | None = None, generated_at: str | None = None) -> dict:
    """Replace the staged files and tables of a dataset, keep its others with their row counts, manifest last; an error changes nothing.

    A staged entry is its bytes, or the path of a written file or, for a name ending in .parquet, of a written table; paths are moved.
    """
    folder.mkdir(parents=True, exist_ok=True)
    old = read_manifest(folder) if (folder / MANIFEST).exists() else {"files": []}
    known = {f["name"]: f["rows"] for f in old["files"] if "rows" in f}
    stage = folder / ".stage"
    shutil.rmtree(stage, ignore_errors=True)
    stage.mkdir()
    try:
        for name, data in staged.items():
            if isinstance(data, bytes):
                (stage / name).write_bytes(data)
            else:
                os.replace(data, stage / name)
        kept = {n: p for n, p in _files(folder).items() if n.split("/")[0] not in staged}
        counts = {**{k: v for k, v in known.items() if k in kept}, **(rows or {})}
        made = build_manifest({**kept, **_files(stage)}, source_urls, license_note, counts, extra, generated_at)
        for name in staged:
            if (folder / name).is_dir():
                os.replace(folder / name, stage / f".old-{name}")
            os.replace(stage / name, folder / name)
        return _write_manifest(folder, made)
    finally:
        shutil.rmtree(stage, ignore_errors=True)


def verified_path(folder: Path, name: str) -> tuple[Path, str]:
    """A manifested file whose bytes are what the manifest says, and their digest."""
    entry = next((f for f in read_manifest(folder)["files"] if f["name"] == name), None)
    path = folder / name
    if entry is None or not path.is_file():
        raise RefusalError(f"{path} is not there or not in its manifest")
    if (digest := sha256_of(path)) != entry["sha256"]:
        raise RefusalError(f"{path} is not the file its manifest lists")
    return path, digest


def read_verified(spark: SparkSession, folder: Path, name: str, schema: str) -> DataFrame:
    from tidemark.sources.scans import json_lines

    path, _ = verified_path(folder, name)
    return json_lines(spark, path.as_uri(), schema)


def write_table(df: DataFrame, path: Path) -> dict[str, int]:
    """A Parquet table to be staged, and its rows by part name; an empty one keeps its columns."""
    df.write.mode("overwrite").parquet(path.as_uri())
    parts = df.sparkSession.read.schema(df.schema).parquet(path.as_uri()).groupBy(F.col("_metadata.file_name").alias("f")).count().collect()  # a row per part
    return {p.name: 0 for p in path.glob("part-*")} | {r["f"]: r["count"] for r in parts}


def read_table(spark: SparkSession, folder: Path, name: str) -> DataFrame:
    """A published table, all parts of which are what the manifest lists, and no others."""
    listed = [f["name"] for f in read_manifest(folder)["files"] if f["name"].startswith(f"{name}/")]
    there = [n for n in _files(folder) if n.startswith(f"{name}/")]
    if not listed or sorted(listed) != sorted(there):
        raise RefusalError(f"{folder / name} is not the table its manifest lists")
    for n in listed:
        verified_path(folder, n)
    return spark.read.parquet((folder / name).as_uri())


def heartbeat(folder: Path, text: str) -> None:
    write_atomically(folder / "heartbeat.txt", (text + "\n").encode())
