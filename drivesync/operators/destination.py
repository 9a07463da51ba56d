"""Applying parsed records to a set of files: who wins, and with what bytes."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drivesync.operators.apply import apply_latest
from drivesync.operators.reassemble import FILE_KEY, chunk_manifest, segment_of, segments
from drivesync.schemas import ERR_CORRUPT


def chunk_rows(parsed: DataFrame) -> DataFrame:
    """Chunk input of the reassembly from valid parsed records."""
    return parsed.where((F.col("action") == "chunk") & F.col("error").isNull()).select(
        *FILE_KEY,
        "chunk_index",
        "size",
        "seq",
        "length",
        F.coalesce("payload_after", F.lit(b"")).alias("data"),
    )


def full_rows(parsed: DataFrame) -> DataFrame:
    """Whole-file writes shaped like the only segment of a file; chunk_count is 0."""
    data = F.coalesce("payload_after", F.lit(b""))
    one = F.lit(1).cast("long")
    return parsed.where((F.col("action") == "full") & F.col("error").isNull()).select(
        "target_path",
        "hash",
        F.lit(0).cast("long").alias("chunk_count"),
        F.lit(0).cast("long").alias("segment"),
        one.alias("have"),
        one.alias("want"),
        F.col("length").alias("bytes"),
        "seq",
        F.col("seq").alias("last_seq"),
        "size",
        data.alias("content"),
    )


def file_events(parsed: DataFrame) -> DataFrame:
    """Commits and deletes by path; on stored actions no payload is read.

    A write whose stored size is not the declared one is reported by
    ``failed_writes`` and does not become a version of the file.
    """
    chunked = chunk_manifest(chunk_rows(parsed).drop("data")).where(F.col("status") == "complete").select(
        "target_path", "seq", "size", "hash", "chunk_count", F.lit(False).alias("deleted")
    )
    full = full_rows(parsed).where(F.col("bytes") == F.col("size")).select(
        "target_path", "seq", "size", "hash", "chunk_count", F.lit(False).alias("deleted")
    )
    gone = parsed.where((F.col("action") == "delete") & F.col("error").isNull()).select(
        "target_path",
        "seq",
        F.lit(None).cast("long").alias("size"),
        F.lit(None).cast("string").alias("hash"),
        F.lit(None).cast("long").alias("chunk_count"),
        F.lit(True).alias("deleted"),
    )
    return chunked.unionByName(full).unionByName(gone)


def live_files(parsed: DataFrame) -> DataFrame:
    """Files that exist after all records: target_path, seq, size, hash, chunk_count."""
    return apply_latest(file_events(parsed), path="target_path")


def failed_writes(parsed: DataFrame) -> DataFrame:
    """Writes whose stored bytes differ from the declared size, with both sizes."""
    full = full_rows(parsed).where(F.col("bytes") != F.col("size")).select(
        "target_path", "seq", "bytes", "size",
        F.format_string(f"{ERR_CORRUPT}: stored %d, declared %d", "bytes", "size").alias("error"),
    )
    chunked = chunk_manifest(chunk_rows(parsed).drop("data")).where(
        F.col("status") == "corrupt"
    ).select(
        "target_path", "seq", "bytes", "size", "error"
    )
    return full.unionByName(chunked)


def stored_segments(parsed: DataFrame) -> DataFrame:
    """Segments of everything written, whole files included."""
    return segments(chunk_rows(parsed)).unionByName(full_rows(parsed))


def file_segments(parsed: DataFrame, live: DataFrame) -> DataFrame:
    """Content of the live files as ordered segments (one for most files).

    The live files are named segment by segment: the join then finds the
    rebuilt segments partitioned as it needs them, and moves no payload again.
    """
    version = [*FILE_KEY, "seq"]
    last = segment_of(F.col("chunk_count"))
    wanted = live.where(F.col("chunk_count") > 0).select(
        *FILE_KEY, F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("segment")
    )
    chunked = segments(chunk_rows(parsed)).join(wanted, [*FILE_KEY, "segment"], "left_semi")
    full = full_rows(parsed).join(
        live.where(F.col("chunk_count") == 0).select(*version), version, "left_semi"
    )
    return chunked.unionByName(full)
