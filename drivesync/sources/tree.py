"""A directory tree on a mount that all executors share, as a source.

Listing runs one level at a time, each directory scanned by the task that got
it; file bytes are read as ranges by the executors, never as whole files.
"""

import datetime
import os

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drivesync.functions.numbers import ceil_div, int_div
from drivesync.functions.paths import base_name
from drivesync.operators.chunking import plan_chunks
from drivesync.operators.records import payload_records
from drivesync.operators.routing import is_file
from drivesync.options import check_chunk_size, scope_path
from drivesync.schemas import DEFAULT_CHUNK_SIZE, HASH_BLOCK, TAG_DELETED, TAG_FOLDER
from drivesync.session import shared_dir, task_count

# Names our own sink uses until a file is complete.
PENDING = ".drivesync-"
SCAN_BATCH = 5_000
READ_BATCH_BYTES = 32 * 1024 * 1024

_LISTED = "tag string, id string, path string, server_modified timestamp, size bigint"
_LISTED_ARROW = pa.schema([
    ("tag", pa.string()), ("id", pa.string()), ("path", pa.string()),
    ("server_modified", pa.timestamp("us", tz="UTC")), ("size", pa.int64()),
])


def _require(root):
    """Fail when the tree itself is not there: a lost mount is no empty folder."""
    if not os.path.isdir(root or "/"):
        raise FileNotFoundError(f"folder {root!r} is not there, is it mounted?")


def _scan_folders(root, top=""):
    def rows(folder):
        try:
            found = os.scandir(root + folder)
        except (FileNotFoundError, NotADirectoryError):
            # Removed since its parent was listed; the top has none.
            _require(root + top)
            return
        with found:
            for item in found:
                if item.name.startswith(PENDING):
                    continue
                path = f"{folder}/{item.name}"
                if item.is_dir(follow_symlinks=False):
                    yield TAG_FOLDER, None, path, None, None
                elif item.is_file(follow_symlinks=False):
                    try:
                        stat = item.stat(follow_symlinks=False)
                    except FileNotFoundError:
                        continue  # removed since, the others are still there
                    when = datetime.datetime.fromtimestamp(
                        stat.st_mtime_ns // 1_000_000_000, datetime.timezone.utc
                    ).replace(microsecond=stat.st_mtime_ns // 1000 % 1_000_000)
                    yield "file", f"id:{stat.st_ino}", path, when, stat.st_size

    def scan(batches):
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                held = []
                for row in rows(folder):
                    held.append(row)
                    if len(held) == SCAN_BATCH:
                        yield to_batch(held)
                        held = []
                if held:
                    yield to_batch(held)

    def to_batch(held):
        return pa.RecordBatch.from_arrays(
            [pa.array(column, field.type) for column, field in zip(zip(*held), _LISTED_ARROW)],
            schema=_LISTED_ARROW,
        )

    return scan


def list_tree(
    spark: SparkSession, root: str, path: str = "", recursive: bool = False
) -> DataFrame:
    """Listing of ``root`` below ``path``; paths are relative to root, from '/'.

    Content hashes are left null, see ``with_hashes``.
    """
    shared_dir(spark)
    root, tasks = root.rstrip("/"), task_count(spark)
    folders = spark.createDataFrame([(scope_path(path),)], "path string")
    levels = []
    while True:
        # Each level is kept: the next one and the result both read it.
        level = folders.repartition(tasks, "path").mapInArrow(_scan_folders(root, scope_path(path)), _LISTED).checkpoint()
        levels.append(level)
        folders = level.where(F.col("tag") == TAG_FOLDER).select("path")
        if not recursive or not folders.take(1):
            break
    found = levels[0]
    for level in levels[1:]:
        found = found.union(level)
    return found.select(
        "tag", "id", base_name(F.col("path")).alias("name"), "path", "server_modified", "size",
        F.lit(None).cast("string").alias("content_hash"),
    )


def verify_folder(root: str, path: str) -> None:
    """Fail early when the configured folder is not there or is a file."""
    full = root.rstrip("/") + scope_path(path)
    if not os.path.exists(full):
        raise ValueError(f"error verifying remote path {path!r}: not found")
    if not os.path.isdir(full):
        raise ValueError(f"error verifying remote path {path!r}: not a folder")


def read_ranges(plan: DataFrame, root: str) -> DataFrame:
    """Add ``data``: bytes [start, end) of each planned row's file.

    The plan holds no payload, so spreading it by (path, start) is a cheap
    shuffle that also splits a huge file over all tasks. Out of a task go
    batches of at most 32 MiB plus one range. Ranges of a file that is gone by
    now give no row: its tombstone is in the next listing. A root that is gone
    (on this executor, too) fails the task. A file that has
    shrunk gives short ranges, which the size check at the destination finds.
    """
    root = root.rstrip("/")
    names = plan.columns
    at = {n: names.index(n) for n in ("path", "start", "end")}

    def read(batches):
        for batch in batches:
            held, rows, size = [], [], 0
            paths, starts, ends = (
                batch.column(at[n]).to_pylist() for n in ("path", "start", "end")
            )
            for i, (path, start, end) in enumerate(zip(paths, starts, ends)):
                try:
                    with open(root + path, "rb") as file:
                        file.seek(start)
                        data = file.read(end - start)
                    held.append(data)
                    rows.append(i)
                    size += len(data)
                except (FileNotFoundError, NotADirectoryError):
                    _require(root)
                if rows and (size >= READ_BATCH_BYTES or i == len(paths) - 1):
                    part = batch.take(pa.array(rows, pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(held, pa.binary())], names=[*names, "data"]
                    )
                    held, rows, size = [], [], 0

    schema = plan.schema.add("data", "binary")
    tasks = task_count(plan.sparkSession)
    return plan.repartition(tasks, "path", "start").mapInArrow(read, schema)


def tree_chunks(listing: DataFrame, root: str, chunk_size: int = DEFAULT_CHUNK_SIZE) -> DataFrame:
    """Chunk payloads of the files above ``chunk_size``."""
    return read_ranges(plan_chunks(listing, chunk_size), root)


def tree_payloads(listing: DataFrame, root: str, chunk_size: int = DEFAULT_CHUNK_SIZE) -> DataFrame:
    """Payload rows of all files: whole when small, in ranges when not."""
    check_chunk_size(chunk_size)
    files = listing.where(is_file(F.col("tag")))
    small = files.where(F.col("size") <= chunk_size).withColumns({
        "chunk_count": F.lit(None).cast("long"),
        "chunk_index": F.lit(None).cast("long"),
        "start": F.lit(0).cast("long"),
        "end": F.col("size"),
    })
    return read_ranges(small.unionByName(plan_chunks(files, chunk_size)), root)


def change_records(
    changes: DataFrame, root: str, chunk_size: int = DEFAULT_CHUNK_SIZE
) -> DataFrame:
    """Records of change-log rows (batch or stream), bytes read from the tree.

    Positions of deletes and of unfinished files carry the ``mark`` of the log.
    """
    gone = changes.where(F.col("tag") == TAG_DELETED).withColumns({
        "kind": F.lit("delete"),
        "chunk_count": F.lit(None).cast("long"),
        "chunk_index": F.lit(None).cast("long"),
        "data": F.lit(None).cast("binary"),
    })
    kind = F.when(F.col("chunk_index").isNull(), "full").otherwise("chunked")
    written = tree_payloads(changes, root, chunk_size).withColumn("kind", kind)
    rows = written.drop("start", "end").unionByName(gone)
    mark = F.coalesce("mark", F.lit(0).cast("long")) if "mark" in changes.columns else None
    return payload_records(rows, F.col("seq").cast("string"), mark)


def with_hashes(listing: DataFrame, root: str, known: DataFrame | None = None) -> DataFrame:
    """Fill ``content_hash``; ``known`` is an earlier listing whose hashes are kept
    for files of unchanged size and modification time, so only new bytes are read.
    """
    files = listing.where(is_file(F.col("tag"))).drop("content_hash")
    other = listing.where(~is_file(F.col("tag")))
    if known is None:
        fresh, kept = files, None
    else:
        old = known.where(F.col("content_hash").isNotNull()).select(
            "path", "size", "server_modified", "content_hash"
        )
        same = ["path", "size", "server_modified"]
        kept = files.join(old, same).select(*listing.columns)
        fresh = files.join(old, same, "left_anti")
    blocks = ceil_div(F.col("size"), HASH_BLOCK)
    plan = fresh.select("path", "size", F.explode(F.sequence(F.lit(1).cast("long"), blocks)).alias("b"))
    plan = plan.select(
        "path",
        "b",
        ((F.col("b") - 1) * HASH_BLOCK).alias("start"),
        F.least(F.col("b") * HASH_BLOCK, F.col("size")).alias("end"),
    )
    run = int_div(F.col("b") - 1, 16_384)
    digests = read_ranges(plan, root).select(
        "path", "b", run.alias("run"),
        F.when(F.col("end") > 0, F.sha2("data", 256)).otherwise("").alias("digest"),
    )

    def joined(order):
        items = F.sort_array(F.collect_list(F.struct(order, "digest")))
        return F.array_join(items["digest"], "")

    hashes = (
        digests.groupBy("path", "run").agg(joined("b").alias("digest"))
        .groupBy("path").agg(F.sha2(F.unhex(joined("run")), 256).alias("content_hash"))
    )
    done = fresh.join(hashes, "path").select(*listing.columns).unionByName(other)
    return done if kept is None else done.unionByName(kept)


