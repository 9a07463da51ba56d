"""Resume positions as JSON text, and the values that go into them."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from drivesync.schemas import CHUNK_INFO, POSITION


def unix_nanos(ts: Column) -> Column:
    return F.unix_micros(ts) * F.lit(1000).cast("long")


def chunk_info(file_id: Column, path: Column, index: Column, count: Column) -> Column:
    """Resume info of an unfinished chunked file, null once its last chunk is out."""
    info = F.struct(
        file_id.alias("file_id"),
        path.alias("file_path"),
        index.alias("chunk_index"),
        count.alias("total_chunks"),
    )
    return F.when(index < count, info).otherwise(F.lit(None).cast(CHUNK_INFO))


def encode_position(cursor: Column, info: Column, last_processed: Column) -> Column:
    """JSON text; an absent ``chunk_info`` is written as an explicit null."""
    return F.to_json(
        F.struct(
            cursor.alias("cursor"),
            info.alias("chunk_info"),
            last_processed.alias("last_processed_unix_time"),
        ),
        {"ignoreNullFields": "false"},
    )


def decode_position(position: Column) -> Column:
    """Struct of the JSON text; null gives an empty position, bad JSON an error.

    Keys missing from the text take their empty value.
    """
    parsed = F.from_json(position, POSITION, {"mode": "FAILFAST"})
    return F.struct(
        F.coalesce(parsed["cursor"], F.lit("")).alias("cursor"),
        parsed["chunk_info"].alias("chunk_info"),
        F.coalesce(parsed["last_processed_unix_time"], F.lit(0).cast("long")).alias(
            "last_processed_unix_time"
        ),
    )
