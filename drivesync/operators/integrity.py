"""Checks on stored files and the sync report."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drivesync.functions.hashing import content_hash
from drivesync.operators.chunking import chunk_count
from drivesync.operators.reassemble import FILE_KEY
from drivesync.schemas import ERR_CORRUPT, ERR_HASH_DIFFERS


def check_sizes(files: DataFrame) -> DataFrame:
    """``files(path, declared, content)``: declared against stored size."""
    actual = F.octet_length("content").cast("long")
    return files.select(
        "path",
        "declared",
        actual.alias("actual"),
        F.when(actual == F.col("declared"), "ok").otherwise(ERR_CORRUPT).alias("status"),
    )


def verify_hashes(hashed: DataFrame) -> DataFrame:
    """``hashed`` (the file key and ``content_hash``, see ``hash_segments``) with
    ``ok``: is the stored content what its producer declared? An empty declared
    hash claims nothing."""
    declared = F.col("hash")
    return hashed.select(*FILE_KEY, "content_hash", ((declared == "") | (declared == F.col("content_hash"))).alias("ok"))


def refuse_wrong_hashes(parsed: DataFrame) -> DataFrame:
    """Parsed records, with an error on whole writes whose payload is not the
    declared content. Chunks are checked when their file is put together."""
    payload = F.coalesce("payload_after", F.lit(b""))
    wrong = (
        F.col("error").isNull() & (F.col("action") == "full") & (F.col("length") == F.col("size"))
        & (F.col("hash") != "") & (content_hash(payload) != F.col("hash"))
    )
    return parsed.withColumn("error", F.when(wrong, ERR_HASH_DIFFERS).otherwise(F.col("error")))


def sync_report(files: DataFrame, chunk_size: int) -> DataFrame:
    """Files, bytes and records (chunks; one for a whole file) per collection."""
    return files.groupBy("collection").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("size").cast("long").alias("bytes"),
        F.sum(chunk_count(F.col("size"), chunk_size)).cast("long").alias("chunks"),
    )


def sync_outcomes(parsed: DataFrame, collection: Column) -> DataFrame:
    """Checked records per collection: those written with their bytes, deletes, failures."""
    failed = F.col("error").isNotNull()
    gone = ~failed & (F.col("action") == "delete")
    written = ~failed & (F.col("action") != "delete")
    return parsed.groupBy(collection.alias("collection")).agg(
        F.count_if(written).alias("written"),
        F.sum(F.when(written, F.col("length")).otherwise(0)).cast("long").alias("bytes"),
        F.count_if(gone).alias("deleted"),
        F.count_if(failed).alias("failed"),
    )


def compare_files(source: DataFrame, stored: DataFrame) -> DataFrame:
    """Round trip check of two ``(path, size, content_hash)`` sets."""
    there = stored.select(
        "path", F.col("size").alias("_size"), F.col("content_hash").alias("_hash")
    )
    same = (F.col("size") == F.col("_size")) & (F.col("content_hash") == F.col("_hash"))
    return source.join(there, "path", "full_outer").select(
        "path", F.coalesce(same, F.lit(False)).alias("ok")
    )
