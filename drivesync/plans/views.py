"""The given tables seen as a drive: files, a change log, snapshots, records.

Nothing is left out: each view covers its table as a whole. Where a view
needs faults or changes, they follow from columns of the data (folder,
language, labels), so that SQL can state the same.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drivesync.functions.hashing import content_hash
from drivesync.functions.paths import explode_ancestors, parent_dir
from drivesync.operators.records import to_records
from drivesync.schemas import (
    CHUNK_COUNT, CHUNK_INDEX, FILE_HASH, FILE_NAME, FILE_SIZE,
)

# Payload bytes of a micro-batch; some entries of the log are larger.
BYTES_PER_BATCH = 4096
CHUNK = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drive_of(documents: DataFrame, *keep: str) -> DataFrame:
    """Documents as files with their bytes, and further columns to ``keep``."""
    content = F.col("text").cast("binary")
    return documents.select(
        "doc_id",
        "lang",
        "source",
        F.lit("file").alias("tag"),
        F.concat(F.lit("id:"), "doc_id").alias("id"),
        F.concat("doc_id", F.lit(".txt")).alias("name"),
        F.concat(F.lit("/"), "source", F.lit("/"), "lang", F.lit("/"), "doc_id", F.lit(".txt"))
        .alias("path"),
        # 2024-01-01 00:00:00 UTC plus one second per document.
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("doc_id")).alias("server_modified"),
        F.octet_length(content).cast("long").alias("size"),
        content.alias("content"),
        *keep,
    )


def drive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files without a hash column; the hash costs a pass over the bytes."""
    return drive_of(table(spark, sf_dir, "documents"))


def hashed_drive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drive(spark, sf_dir).withColumn("content_hash", content_hash(F.col("content")))


def folder_entries(files: DataFrame) -> DataFrame:
    """Folder rows for every folder that holds a file or a folder."""
    paths = explode_ancestors(files.select("path"), "path", "folder").select("folder").distinct()
    return paths.select(F.lit("folder").alias("tag"), F.col("folder").alias("path"))


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a change log: errors are tombstones, signups folders, the rest files."""
    events = table(spark, sf_dir, "events")
    gone = F.col("event_type") == "error"
    folder = F.col("event_type") == "signup"
    # The table's times carry no zone; they are UTC whatever the session's is.
    utc = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts")).cast("timestamp")
    return events.select(
        F.col("event_id").alias("seq"),
        F.when(gone, "deleted").when(folder, "folder").otherwise("file").alias("tag"),
        F.concat(F.lit("id:"), "user_id").alias("id"),
        F.concat("user_id", F.lit(".bin")).alias("name"),
        F.concat(F.lit("/u"), F.col("user_id") % 7, F.lit("/"), "user_id", F.lit(".bin")).alias("path"),
        utc.alias("server_modified"),
        (F.col("event_id") % 5000).alias("size"),
        "value",
    )


def old_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot A: every document."""
    return hashed_drive(spark, sf_dir).select("path", "tag", "size", "content_hash")


def new_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot B: toxic documents removed, low-quality ones edited, pages added."""
    # Both hashes are taken where the bytes are; no text goes through the join.
    content, edited = F.col("content"), F.concat("content", F.lit(b"!"))
    hashed = drive(spark, sf_dir).select(
        "doc_id", "path", "tag", "size",
        content_hash(content).alias("_as_is"), content_hash(edited).alias("_edited"),
    )
    low = F.coalesce(F.col("quality") == 0, F.lit(False))
    files = (
        hashed.join(table(spark, sf_dir, "labels"), "doc_id", "left")
        .where(F.coalesce(F.col("toxic"), F.lit(0)) == 0)
        .select(
            "path",
            "tag",
            F.when(low, F.col("size") + 1).otherwise(F.col("size")).alias("size"),
            F.when(low, F.col("_edited")).otherwise(F.col("_as_is")).alias("content_hash"),
        )
    )
    html = F.col("html").cast("binary")
    pages = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("/pages/"), "page_id", F.lit(".html")).alias("path"),
        F.lit("file").alias("tag"),
        F.octet_length(html).cast("long").alias("size"),
        content_hash(html).alias("content_hash"),
    )
    return files.union(pages)


def records(spark: SparkSession, sf_dir: str, chunk_size: int = CHUNK) -> DataFrame:
    """Snapshot records of the drive; the cursor is the file's place in the listing."""
    entries = hashed_drive(spark, sf_dir).withColumn("seq", F.col("doc_id"))
    return to_records(entries, chunk_size, F.col("seq").cast("string"))


# What is wrong with the records of a source folder.
NO_HASH, NO_SIZE, BAD_SIZE, NO_NAME = "src1", "src2", "src3", "src4"
NO_INDEX, NO_COUNT, BAD_INDEX, BAD_COUNT = "src5", "src6", "src7", "src8"
BAD_HASH = "src3"
FAULTY_SOURCES = [
    NO_HASH, NO_SIZE, BAD_SIZE, NO_NAME, NO_INDEX, NO_COUNT, BAD_INDEX, BAD_COUNT,
]


def faulty_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drive's records with metadata damaged by source folder."""
    source = F.col("_source")
    dropped = (
        F.when(source == NO_HASH, FILE_HASH)
        .when(source == NO_SIZE, FILE_SIZE)
        .when(source == NO_NAME, FILE_NAME)
        .when(source == NO_INDEX, CHUNK_INDEX)
        .when(source == NO_COUNT, CHUNK_COUNT)
        .otherwise("")
    )

    def damage(key, value):
        return (
            F.when((source == BAD_SIZE) & (key == FILE_SIZE), F.concat(value, F.lit("x")))
            .when((source == BAD_INDEX) & (key == CHUNK_INDEX), F.lit("x"))
            .when((source == BAD_COUNT) & (key == CHUNK_COUNT), F.lit("1.5"))
            .otherwise(value)
        )

    kept = F.map_filter("metadata", lambda key, value: key != F.col("_dropped"))
    rows = records(spark, sf_dir).withColumn("_source", F.split("key.file_path", "/")[1])
    damaged = F.when(source.isin(*FAULTY_SOURCES), F.transform_values(kept, damage)).otherwise(
        F.col("metadata")
    )
    return rows.withColumn("_dropped", dropped).withColumn("metadata", damaged).drop(
        "_source", "_dropped"
    )
