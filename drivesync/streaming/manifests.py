"""Commit files of the change log: a version exists once its manifest does.

A version is written to a folder of its own attempt first. Its manifest is then
put in place by a rename that never replaces, so of several attempts at one
version exactly one counts; it is the commit. Only then does the data move to
where readers and streams look, which anyone may finish after a failure. What
was not committed is never seen, and a position is never given twice.

Renames that replace nothing are atomic on file systems; on a store without
them, let one job poll at a time.
"""

from __future__ import annotations

import dataclasses
import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

COMMITS, STAGED, COMPACTED = "commits", "staged", "compacted"


class VersionTaken(RuntimeError):
    """Another attempt has committed this version first."""


@dataclasses.dataclass(frozen=True)
class Manifest:
    """``first_seq`` to ``last_seq`` in ``files`` data files with ``size`` payload bytes; ``mark`` is
    the newest modification time (nanoseconds) up to the end of the version."""

    version: int
    attempt: str
    files: int
    rows: int
    first_seq: int
    last_seq: int
    mark: int
    size: int


@dataclasses.dataclass(frozen=True)
class Compaction:
    """The last change per path of the positions ``floor + 1`` to ``last_seq``, in ``files`` data files."""

    floor: int
    last_seq: int
    files: int


def compaction_dir(log_dir: str, part: Compaction) -> str:
    return f"{log_dir}/{COMPACTED}/{part.last_seq}-{part.floor}-{part.files}"


def new_attempt(version: int) -> str:
    return f"{version:010d}-{uuid.uuid4().hex}"


def version_dir(folder: str, version: int) -> str:
    return f"{folder}/version={version:010d}"


def staged_dir(log_dir: str, attempt: str) -> str:
    return f"{log_dir}/{STAGED}/{attempt}"


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def _store(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _data_files(spark: SparkSession, folder: str) -> list:
    """Paths of the Parquet files below a folder, which need not exist."""
    path = _path(spark, folder)
    store = _store(spark, path)
    if not store.exists(path):
        return []
    found, walk = [], store.listFiles(path, True)
    while walk.hasNext():
        file = walk.next().getPath()
        if file.getName().endswith(".parquet"):
            found.append(file)
    return found


def count_files(spark: SparkSession, folder: str) -> int:
    return len(_data_files(spark, folder))


def versions(spark: SparkSession, log_dir: str) -> list[int]:
    """Committed versions, newest first, from file names alone."""
    path = _path(spark, f"{log_dir}/{COMMITS}/*.json")
    found = _store(spark, path).globStatus(path) or []
    return sorted((int(f.getPath().getName().removesuffix(".json")) for f in found), reverse=True)


def read(spark: SparkSession, log_dir: str, version: int) -> Manifest:
    path = _path(spark, f"{log_dir}/{COMMITS}/{version:010d}.json")
    stream = _store(spark, path).open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Manifest(**json.loads(text))


def newest(spark: SparkSession, log_dir: str) -> Manifest | None:
    known = versions(spark, log_dir)
    return read(spark, log_dir, known[0]) if known else None


def oldest(spark: SparkSession, log_dir: str) -> Manifest | None:
    known = versions(spark, log_dir)
    return read(spark, log_dir, known[-1]) if known else None


def commit(spark: SparkSession, log_dir: str, manifest: Manifest) -> None:
    """Put the manifest in place; ``VersionTaken`` when there is one for its version."""
    name = f"{log_dir}/{COMMITS}/{manifest.version:010d}.json"
    path, draft = _path(spark, name), _path(spark, f"{log_dir}/{COMMITS}/.draft-{manifest.attempt}")
    store = _store(spark, path)
    out = store.create(draft, True)
    try:
        out.write(bytearray(json.dumps(dataclasses.asdict(manifest)).encode()))
    finally:
        out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), spark._jsc.hadoopConfiguration())
    # No option means: never replace.
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    full = store.makeQualified
    try:
        context.rename(full(draft), full(path), options)
    except Py4JJavaError as error:
        store.delete(draft, False)
        if store.exists(path):
            raise VersionTaken(f"log version {manifest.version} was committed by another job") from error
        raise


def publish(spark: SparkSession, log_dir: str, manifest: Manifest) -> None:
    """Move the data of a committed version to where it is read. May be run again,
    by any job, until all files are there."""
    target = version_dir(log_dir, manifest.version)
    staged = staged_dir(log_dir, manifest.attempt)
    store = _store(spark, _path(spark, log_dir))
    if not store.exists(_path(spark, target)):
        store.rename(_path(spark, staged), _path(spark, target))
    else:
        # A store that renames file by file has stopped half-way.
        for file in _data_files(spark, staged):
            place = _path(spark, target + file.toString().split(f"/{manifest.attempt}", 1)[1])
            store.mkdirs(place.getParent())
            store.rename(file, place)
    if not is_published(spark, log_dir, manifest):
        raise RuntimeError(f"log version {manifest.version} is committed but not all of its files are there")


def is_published(spark: SparkSession, log_dir: str, manifest: Manifest) -> bool:
    return count_files(spark, version_dir(log_dir, manifest.version)) >= manifest.files


def recover(spark: SparkSession, log_dir: str) -> Manifest | None:
    """Finish the newest commit, remove attempts that lost or died; returns that commit.

    Attempts at the version that follows may belong to a job that is still running.
    """
    last = newest(spark, log_dir)
    if last is not None:
        if not is_published(spark, log_dir, last):
            publish(spark, log_dir, last)
        path = _path(spark, f"{log_dir}/{STAGED}")
        store = _store(spark, path)
        for status in store.listStatus(path) if store.exists(path) else []:
            if int(status.getPath().getName().split("-")[0]) <= last.version:
                store.delete(status.getPath(), True)
    return last


def _compactions(spark: SparkSession, log_dir: str) -> list[Compaction]:
    """Parts all of whose files are there, newest first."""
    path = _path(spark, f"{log_dir}/{COMPACTED}")
    store = _store(spark, path)
    found = []
    for status in store.listStatus(path) if store.exists(path) else []:
        last_seq, floor, files = map(int, status.getPath().getName().split("-"))
        part = Compaction(floor, last_seq, files)
        if count_files(spark, compaction_dir(log_dir, part)) >= files:
            found.append(part)
    return sorted(found, key=lambda part: part.last_seq, reverse=True)


def compaction(spark: SparkSession, log_dir: str) -> Compaction | None:
    """The newest complete compacted part of the log."""
    return next(iter(_compactions(spark, log_dir)), None)


def replace_compaction(spark: SparkSession, log_dir: str, staged: str, part: Compaction) -> None:
    """Put a written part in place, then remove what it replaces. Its name tells
    how many files it has, so one moved half-way is not taken for a part."""
    target = compaction_dir(log_dir, part)
    path = _path(spark, target)
    store = _store(spark, path)
    store.mkdirs(path.getParent())
    store.delete(path, True)
    if not store.rename(_path(spark, staged), path):
        raise RuntimeError(f"compacted log was not put in place at {target}")
    for status in store.listStatus(path.getParent()):
        if status.getPath().getName() != path.getName():
            store.delete(status.getPath(), True)
