"""Entry routing: what each listed or changed entry turns into."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drivesync.options import check_chunk_size
from drivesync.schemas import TAG_DELETED, TAG_FOLDER


def is_file(tag: Column) -> Column:
    """Anything that is neither a folder nor a tombstone, untagged included."""
    return ~F.coalesce(tag, F.lit("")).isin(TAG_FOLDER, TAG_DELETED)


def route(entries: DataFrame, chunk_size: int) -> DataFrame:
    """Add ``kind``: dropped, delete, chunked (strictly above the size) or full."""
    check_chunk_size(chunk_size)
    tag = F.coalesce(F.col("tag"), F.lit(""))
    return entries.withColumn(
        "kind",
        F.when(tag == TAG_FOLDER, "dropped")
        .when(tag == TAG_DELETED, "delete")
        .when(F.col("size") > chunk_size, "chunked")
        .otherwise("full"),
    )
