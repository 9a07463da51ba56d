"""Chunk plans, resume inside a file, and cutting content into payloads."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drivesync.functions.numbers import ceil_div
from drivesync.operators.routing import route
from drivesync.options import check_chunk_size


def chunk_count(size: Column, chunk_size: int) -> Column:
    return ceil_div(size, chunk_size)


def plan_chunks(
    entries: DataFrame, chunk_size: int, saved: DataFrame | None = None
) -> DataFrame:
    """One row per byte range of every file above ``chunk_size``.

    ``saved(id, saved_index)`` are the chunk positions of files left
    unfinished; their plan starts after that chunk. Entries must not carry
    content: the plan is what gets shuffled, bytes are read last.
    """
    check_chunk_size(chunk_size)
    files = route(entries, chunk_size).where(F.col("kind") == "chunked").drop("kind")
    files = files.withColumn("chunk_count", chunk_count(F.col("size"), chunk_size))
    first = F.lit(1).cast("long")
    if saved is not None:
        files = files.join(saved.select("id", "saved_index"), "id", "left")
        first = F.coalesce(F.col("saved_index"), F.lit(0)) + 1
        files = files.where(first <= F.col("chunk_count"))
    planned = files.withColumn("chunk_index", F.explode(F.sequence(first, F.col("chunk_count"))))
    planned = planned.drop("saved_index")
    start = (F.col("chunk_index") - 1) * F.lit(chunk_size)
    return planned.withColumn("start", start).withColumn(
        "end", F.least(start + F.lit(chunk_size), F.col("size"))
    )


def pieces(content: Column, size: Column, chunk_size: int) -> Column:
    """Content cut into an array of (chunk_index, data).

    The array is exploded in place of the content, so the bytes are copied
    once and never repeated per output row.
    """
    def cut(i: Column) -> Column:
        start = ((i - 1) * chunk_size + 1).cast("int")
        return F.struct(
            i.alias("chunk_index"),
            F.substring(content, start, F.lit(chunk_size)).alias("data"),
        )

    return F.transform(F.sequence(F.lit(1).cast("long"), chunk_count(size, chunk_size)), cut)


def cut_chunks(files: DataFrame, chunk_size: int) -> DataFrame:
    """Chunk payloads of files whose ``content`` sits in the table."""
    check_chunk_size(chunk_size)
    keep = [c for c in files.columns if c != "content"]
    cut = files.where(F.col("size") > chunk_size).select(
        *keep,
        chunk_count(F.col("size"), chunk_size).alias("chunk_count"),
        F.inline(pieces(F.col("content"), F.col("size"), chunk_size)),
    )
    start = (F.col("chunk_index") - 1) * F.lit(chunk_size)
    return cut.withColumn("start", start).withColumn(
        "end", F.least(start + F.lit(chunk_size), F.col("size"))
    )
