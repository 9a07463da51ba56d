"""Files written into a directory tree on a mount that all executors share.

Segments go to their byte offset in a pending file, each by its own task, so a
huge file is written in parallel and never held as a whole; a file shows under
its name only after all of it is there and its size is right. Every step can
be repeated: a retried task writes the same bytes to the same place.
"""

import contextlib
import hashlib
import os
import shutil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drivesync.operators.destination import file_segments, live_files
from drivesync.operators.integrity import verify_hashes
from drivesync.operators.reassemble import (
    FILE_KEY, SEGMENT_CHUNKS, hash_placed, place_segments, read_segments, store_segments,
)
from drivesync.operators.skew import are_few, lookup_join
from drivesync.schemas import ERR_CORRUPT, ERR_HASH_DIFFERS
from drivesync.session import new_dir, remove_dir, shared_dir, task_count
from drivesync.sources.tree import PENDING

VERSION = [*FILE_KEY, "size"]


def pending_name(root: str, path: str, version) -> str:
    """Where a version of a file is gathered, next to its final place."""
    folder, _ = os.path.split(root + path)
    tag = hashlib.sha256(repr((path, *version)).encode()).hexdigest()[:32]
    return os.path.join(folder, PENDING + tag)


def _write_pieces(root):
    def write(batches):
        for batch in batches:
            rows = batch.to_pydict()
            for path, file_hash, count, size, offset, content in zip(
                *(rows[n] for n in (*VERSION, "offset", "content"))
            ):
                name = pending_name(root, path, (file_hash, count, size))
                os.makedirs(os.path.dirname(name), exist_ok=True)
                handle = os.open(name, os.O_CREAT | os.O_WRONLY, 0o644)
                try:
                    at = offset
                    view = memoryview(content)
                    while len(view):
                        done = os.pwrite(handle, view, at)
                        view, at = view[done:], at + done
                finally:
                    os.close(handle)
            yield pa.RecordBatch.from_pydict(
                {n: batch.column(n) for n in VERSION}
                | {"bytes": pa.array([len(c) for c in rows["content"]], pa.int64())}
            )

    return write


def _move(name, target):
    try:
        os.replace(name, target)
    except IsADirectoryError:
        # A folder that deletes have emptied; one with files in it stays and the move fails.
        for folder, _, _ in os.walk(target, topdown=False):
            os.rmdir(folder)
        os.replace(name, target)


def _commit_files(root):
    def commit(batches):
        for batch in batches:
            rows = batch.to_pydict()
            status = []
            for path, file_hash, count, size, written, right in zip(
                *(rows[n] for n in (*VERSION, "bytes", "ok"))
            ):
                name = pending_name(root, path, (file_hash, count, size))
                try:
                    if not right:
                        with contextlib.suppress(FileNotFoundError):
                            os.remove(name)
                        status.append(ERR_HASH_DIFFERS)
                        continue
                    if os.path.exists(name):
                        if written != size or os.path.getsize(name) != size:
                            os.remove(name)
                            status.append(f"{ERR_CORRUPT}: stored {written}, declared {size}")
                            continue
                        _move(name, root + path)
                    # Else an earlier attempt of this task has moved it.
                    ok = os.path.isfile(root + path) and os.path.getsize(root + path) == size
                    status.append("ok" if ok else "missing after commit")
                except OSError as error:
                    status.append(f"failed: {error.strerror}")
                    with contextlib.suppress(OSError):
                        os.remove(name)
            yield pa.RecordBatch.from_pydict({
                "target_path": batch.column("target_path"),
                "size": batch.column("size"),
                "status": pa.array(status, pa.string()),
            })

    return commit


def _remove_paths(root):
    def remove(batches):
        for batch in batches:
            paths = batch.column(0).to_pylist()
            status = []
            for path in paths:
                full = root + path
                if path in ("", "/"):
                    status.append("refused")
                    continue
                if os.path.isdir(full) and not os.path.islink(full):
                    try:
                        shutil.rmtree(full)
                        status.append("deleted")
                    except OSError as error:
                        status.append(f"failed: {error.strerror}")
                else:
                    try:
                        os.remove(full)
                        status.append("deleted")
                    except (FileNotFoundError, NotADirectoryError):
                        status.append("missing")
            yield pa.RecordBatch.from_pydict(
                {"target_path": batch.column(0), "status": pa.array(status, pa.string())}
            )

    return remove


def write_files(parts: DataFrame, root: str, verify: bool = True) -> DataFrame:
    """Write the files made of stored segments; gives target_path, size, status per file.

    Two jobs: all pieces first, then sizes are checked and files renamed. With
    ``verify`` a file whose content is not what its hash declares is not
    renamed; only hashes meet the rows of the pieces, no payload.
    """
    shared_dir(parts.sparkSession)
    root = root.rstrip("/")
    placed = place_segments(parts)
    schema = "target_path string, hash string, chunk_count bigint, size bigint, bytes bigint"
    written = (
        placed.select(*VERSION, "offset", "content").mapInArrow(_write_pieces(root), schema)
        .groupBy(*VERSION).agg(F.sum("bytes").alias("bytes"))
        .checkpoint()
    )
    if verify:
        checked = verify_hashes(hash_placed(placed)).select(*FILE_KEY, "ok")
        written = written.join(checked, FILE_KEY)
    else:
        written = written.withColumn("ok", F.lit(True))
    tasks = task_count(parts.sparkSession)
    return written.repartition(tasks, "target_path").mapInArrow(
        _commit_files(root), "target_path string, size bigint, status string"
    ).checkpoint()


def delete_paths(paths: DataFrame, root: str) -> DataFrame:
    """Delete files or whole folders; status is deleted, or missing (no error)."""
    shared_dir(paths.sparkSession)
    root = root.rstrip("/")
    tasks = task_count(paths.sparkSession)
    return paths.select("target_path").distinct().repartition(tasks, "target_path").mapInArrow(
        _remove_paths(root), "target_path string, status string"
    ).checkpoint()


def write_versions(parsed: DataFrame, files: DataFrame, root: str, verify: bool = True) -> DataFrame:
    """Write the given versions of files from the records behind them."""
    # Rebuilt once, then read by column: offsets first, content for the writing.
    spark = parsed.sparkSession
    folder = new_dir(spark, "segments")
    try:
        store_segments(file_segments(parsed, files), folder)
        return write_files(read_segments(spark, folder), root, verify)
    finally:
        # The status rows are checkpointed; nothing reads the segments again.
        remove_dir(spark, folder)


def status_rows(deleted: DataFrame, written: DataFrame) -> DataFrame:
    return deleted.select(
        "target_path", F.lit(None).cast("bigint").alias("size"), "status"
    ).unionByName(written)


def apply_to_tree(parsed: DataFrame, root: str, verify: bool = True) -> DataFrame:
    """Apply a batch of parsed records to the tree; one status row per touched path.

    Deletes go first: what a delete of this batch removes and a later record
    writes again is part of the live files and comes back in the second step.
    Uploads have to be whole in the batch, see ``publish`` for streams.
    """
    gone = parsed.where((F.col("action") == "delete") & F.col("error").isNull())
    deleted = delete_paths(gone, root)
    live = live_files(parsed).checkpoint()
    return status_rows(deleted, write_versions(parsed, live, root, verify))


def records_of(actions: DataFrame, new: DataFrame) -> DataFrame:
    """Stored actions that the versions ``new`` are made of.

    No record of a version is older than its ``seq``, so batches before the
    oldest of them are left out by the statistics of their files.
    """
    oldest = new.agg(F.min("seq")).first()[0]
    since = actions.where(F.lit(False) if oldest is None else F.col("seq") >= oldest)
    writes = since.where(F.col("action") != "delete").withColumn(
        "chunk_count", F.coalesce("chunk_count", F.lit(0).cast("long"))
    )
    keys = new.select(*FILE_KEY)
    if are_few(keys):
        return writes.join(F.broadcast(keys), FILE_KEY, "left_semi")
    large = F.col("chunk_count") > SEGMENT_CHUNKS
    return lookup_join(writes, keys, FILE_KEY, ["seq", "chunk_index"], large, "left_semi")


def publish(
    actions: DataFrame, root: str, published: DataFrame, verify: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Bring a tree up to date with a table of stored actions.

    ``published(target_path, seq)`` is what the last call left there (empty at
    first). Gives the status rows and the table to pass next time. What failed
    to be written or deleted keeps its old row there and is tried again by the
    next call.
    """
    shared_dir(actions.sparkSession)
    # Metadata only; kept because every step below asks for it.
    live = live_files(actions).checkpoint()
    at = ["target_path", "seq"]
    new = live.join(published.select(*at), at, "left_anti").checkpoint()
    gone = published.join(live, "target_path", "left_anti")
    deleted = delete_paths(gone, root)
    status = status_rows(deleted, write_versions(records_of(actions, new), new, root, verify))
    done = status.where(F.col("status") == "ok").select("target_path")
    settled = status.where(F.col("status").isin("ok", "deleted", "missing", "refused")).select("target_path")
    kept = published.select(*at).join(settled, "target_path", "left_anti")
    return status, kept.union(new.join(done, "target_path", "left_semi").select(*at)).checkpoint()
