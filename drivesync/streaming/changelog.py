"""The change log: appended by listing diffs, followed as a stream.

A version is committed by its manifest, see ``manifests``; readers and streams
see committed ones only. Log files hold at most one page of entries each, and
entries of a bounded number of payload bytes; a stream takes a fixed number of
files per batch: that is the cap on entries and bytes per micro-batch. The
checkpoint is the saved position; it moves when a batch is committed. No new
file means no batch, which is the wait for changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drivesync.functions.positions import unix_nanos
from drivesync.operators.changes import (
    byte_unit, changes_after, compact_log, diff_listings, next_changes, resync_changes,
)
from drivesync.operators.digests import diff_by_digests
from drivesync.operators.routing import is_file
from drivesync.operators.skew import running
from drivesync.options import DEFAULT_BYTES_PER_FILE, check_page_size, check_positive, scope_path
from drivesync.schemas import CHANGE, LOGGED
from drivesync.session import remove_dir
from drivesync.sources.listing import list_entries
from drivesync.streaming import manifests
from drivesync.streaming.manifests import Manifest, version_dir


class ExpiredPosition(RuntimeError):
    """The log no longer holds what follows a saved position."""


def append_changes(
    old: DataFrame | None, new: DataFrame, log_dir: str, version: int, last_seq: int,
    entries_per_file: int = 1000, last_mark: int = 0, attempt: str | None = None,
    bytes_per_file: int = DEFAULT_BYTES_PER_FILE,
) -> Manifest | None:
    """Commit the diff of two listings as log version ``version``; None if there is none.

    ``old`` is None for the first snapshot. A job that dies before the commit has
    changed nothing a reader sees, and can simply be run again; one that dies
    behind it is finished by ``manifests.recover``. Of two jobs at one version the
    later one fails. ``last_mark`` is the mark behind the versions before it.
    """
    spark = new.sparkSession
    check_page_size(entries_per_file)
    attempt = attempt or manifests.new_attempt(version)
    before = new.limit(0) if old is None else old
    diff = diff_listings if old is None else diff_by_digests
    rows = next_changes(before, new, last_seq, diff).withColumn("_ns", _modified())
    rows = running(rows, [], "seq", {"_seen": ("max", "_ns"), "_before": ("sum", "size")}, inclusive=False)
    mark = F.greatest(F.coalesce("_seen", F.lit(0).cast("long")), F.lit(last_mark).cast("long"))
    rows = rows.withColumns({"mark": mark, "unit": byte_unit(F.col("_before"), F.col("size"), bytes_per_file)})
    staged = manifests.staged_dir(log_dir, attempt)
    rows.select(*LOGGED.names, "unit").sortWithinPartitions("unit", "seq").write.option(
        "maxRecordsPerFile", entries_per_file).partitionBy("unit").parquet(staged)
    written = _read(spark, staged).agg(
        F.count("*"), F.min("seq"), F.max("seq"), F.max(F.greatest("mark", _modified())), F.sum("size")
    ).first() if manifests.count_files(spark, staged) else [0]
    if not written[0]:
        remove_dir(spark, staged)
        return None
    count, first, last, newest, size = written
    manifest = Manifest(
        version, attempt, manifests.count_files(spark, staged), count, first, last, newest or 0, size or 0)
    manifests.commit(spark, log_dir, manifest)
    manifests.publish(spark, log_dir, manifest)
    return manifest


def _read(spark: SparkSession, path: str) -> DataFrame:
    # Units are folders, not a column.
    return spark.read.schema(LOGGED).option("recursiveFileLookup", "true").parquet(path)


def _modified():
    return F.when(is_file(F.col("tag")), unix_nanos(F.col("server_modified")))


def read_log(spark: SparkSession, log_dir: str, after: int | None = None) -> DataFrame:
    """All committed entries, or those behind ``after``."""
    last = manifests.newest(spark, log_dir)
    if last is None:
        return spark.createDataFrame([], LOGGED)
    if manifests.is_published(spark, log_dir, last):
        log = _read(spark, f"{log_dir}/version=*")
    elif manifests.versions(spark, log_dir)[1:]:
        # Its data is still being moved.
        log = _read(spark, f"{log_dir}/version=*").where(F.col("seq") < last.first_seq)
    else:
        return spark.createDataFrame([], LOGGED)
    return log if after is None else changes_after(log, after)


def _versions(spark: SparkSession, folder: str) -> list[int]:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/version=*")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return sorted((int(f.getPath().getName().split("=")[1]) for f in found), reverse=True)


def committed_versions(spark: SparkSession, log_dir: str) -> list[int]:
    """Versions with a manifest, newest first."""
    return manifests.versions(spark, log_dir)


def trim(spark: SparkSession, log_dir: str, before: int, compact: bool = False) -> None:
    """Remove the versions below ``before``, manifests first. With ``compact`` the last
    change of each path is kept of them, see ``compact_versions``."""
    if compact:
        compact_versions(spark, log_dir, before)
    for version in manifests.versions(spark, log_dir):
        if version < before:
            remove_dir(spark, f"{log_dir}/{manifests.COMMITS}/{version:010d}.json")
    _trim_folders(spark, log_dir, before)


def compact_versions(spark: SparkSession, log_dir: str, before: int) -> manifests.Compaction | None:
    """Merge the versions below ``before`` into the compacted part of the log.

    The first compaction begins behind the oldest version there is; consumers
    from there on never need a resync while later trims compact as well. The
    new part replaces the old one when it is complete: a job that dies has
    changed nothing, and can be run again. One job compacts or trims at a time;
    jobs that still read the old part fail and can be run again, too.
    """
    held = manifests.compaction(spark, log_dir)
    known = [v for v in manifests.versions(spark, log_dir) if v < before]
    if not known:
        return held
    last_seq = manifests.read(spark, log_dir, known[0]).last_seq
    floor = manifests.read(spark, log_dir, known[-1]).first_seq - 1
    if held and held.last_seq >= last_seq:
        return held  # a trim that died behind its compaction
    rows = _read(spark, f"{log_dir}/version=*").where(F.col("seq") <= last_seq)
    if held and held.last_seq >= floor:
        rows = rows.where(F.col("seq") > held.last_seq).union(_read(spark, manifests.compaction_dir(log_dir, held)))
        floor = held.floor
    attempt = manifests.staged_dir(log_dir, manifests.new_attempt(before))
    # By position, so that a consumer reads what is behind its own only.
    compact_log(rows).repartitionByRange("seq").sortWithinPartitions("seq").write.parquet(attempt)
    done = manifests.Compaction(floor, last_seq, manifests.count_files(spark, attempt))
    manifests.replace_compaction(spark, log_dir, attempt, done)
    return done


def _trim_folders(spark: SparkSession, folder: str, before: int) -> None:
    for version in _versions(spark, folder):
        if version < before:
            remove_dir(spark, version_dir(folder, version))


def delivered_version(spark: SparkSession, folder: str) -> int | None:
    """Newest log version a query has delivered entries of, as noted in ``folder``."""
    return next(iter(_versions(spark, folder)), None)


def note_delivered(spark: SparkSession, folder: str, version: int) -> None:
    """Note it as an empty folder; older notes go."""
    path = spark._jvm.org.apache.hadoop.fs.Path(version_dir(folder, version))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    _trim_folders(spark, folder, version)


def check_no_gap(seen: list[int], last: int) -> None:
    """Versions follow one another, so a batch that skips one has lost its entries."""
    gap = set(range(last + 1, max(seen, default=last) + 1)) - set(seen)
    if gap:
        raise ExpiredPosition(f"log version {min(gap)} is no longer kept, a resync is needed")


def last_version(spark: SparkSession, log_dir: str) -> int:
    """Newest committed version, 0 without any."""
    return next(iter(manifests.versions(spark, log_dir)), 0)


def last_seq(spark: SparkSession, log_dir: str) -> int:
    """Newest log position, from the newest manifest."""
    last = manifests.newest(spark, log_dir)
    return last.last_seq if last else 0


def follow(
    spark: SparkSession, log_dir: str, path: str = "", recursive: bool = True,
    files_per_batch: int = 1, after: int | None = None,
) -> DataFrame:
    """The log as a stream, limited to a folder; ``after`` is where a new query starts.
    ``version`` is the log version of an entry.

    A query with a checkpoint goes on from that. A new one whose position has
    expired must not start: it would miss what is no longer in the log.
    """
    scope_path(path)
    if after is not None and is_expired(spark, log_dir, after):
        raise ExpiredPosition(f"changes after {after} are no longer kept, a resync is needed")
    check_positive("files_per_batch", files_per_batch)
    log = spark.readStream.schema(LOGGED).option("recursiveFileLookup", "true").option(
        "maxFilesPerTrigger", files_per_batch).parquet(f"{log_dir}/version=*")
    version = F.regexp_extract("_metadata.file_path", r"/version=([0-9]+)/", 1).cast("long")
    log = log.select("*", version.alias("version"))
    if after is not None:
        log = changes_after(log, after)
    return log if recursive and not scope_path(path) else list_entries(log, path, recursive)


def is_expired(spark: SparkSession, log_dir: str, saved: int) -> bool:
    """Whether the successor of ``saved`` is no longer kept, by the oldest manifest."""
    first = manifests.oldest(spark, log_dir)
    return first is not None and saved + 1 < first.first_seq


def is_bridged(spark: SparkSession, log_dir: str, saved: int, part: manifests.Compaction) -> bool:
    """Whether a compacted part leads from ``saved`` to the versions that are kept."""
    return part.floor <= saved and not is_expired(spark, log_dir, part.last_seq)


def open_changes(
    spark: SparkSession, log_dir: str, saved: int, listing: DataFrame, held: DataFrame | None = None,
    mark: int = 0,
) -> DataFrame:
    """What a consumer at ``saved`` has to process: the changes behind it; where
    they were trimmed, the last change of each path if they were compacted from
    ``saved`` on; else a full relisting. Relisted rows stand at the newest
    position, so the consumer goes on from there.

    With ``held(path, content_hash)``, the files the consumer has, a relisting
    is cut to what differs and deletes what vanished; without it, everything
    there is comes again and nothing is deleted. ``mark`` is the mark saved
    with the position.
    """
    if not is_expired(spark, log_dir, saved):
        return read_log(spark, log_dir, saved)
    part = manifests.compaction(spark, log_dir)
    if part and is_bridged(spark, log_dir, saved, part):
        old = changes_after(_read(spark, manifests.compaction_dir(log_dir, part)), saved)
        return old.union(read_log(spark, log_dir, part.last_seq))
    newest = last_seq(spark, log_dir)
    if held is None:
        rows = listing.withColumn("seq", F.lit(newest).cast("long"))
    else:
        rows = resync_changes(listing, held, newest)
    return rows.select(*CHANGE.names, F.lit(mark).cast("long").alias("mark"))
