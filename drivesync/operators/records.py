"""Records built from routed entries: metadata, key, position, payload.

A modification is emitted as a create, like a new file.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drivesync.functions.paths import parent_dir
from drivesync.functions.positions import chunk_info, encode_position, unix_nanos
from drivesync.operators.chunking import chunk_count, pieces
from drivesync.operators.routing import route
from drivesync.schemas import (
    BAD_JSON, CHUNK_COUNT, CHUNK_INDEX, COLLECTION, CREATE, DELETE, ERR_NO_KEY, ERR_NO_OPERATION, ERR_NO_RECORD,
    FILE_CHUNKED, FILE_HASH, FILE_ID, FILE_NAME, FILE_PATH, FILE_SIZE, RECORD_JSON, TAG_DELETED,
)

RECORD_FIELDS = ["position", "operation", "metadata", "key", "payload_before", "payload_after"]
# Operations of the record format. Snapshots and updates write like creates.
OPERATIONS = ("create", "update", "delete", "snapshot")


def place_keys() -> list[Column]:
    return [
        F.lit(FILE_NAME), F.col("name"),
        F.lit(FILE_PATH), F.col("path"),
        F.lit(COLLECTION), parent_dir(F.col("path")),
    ]


def metadata(kind: Column, index: Column, count: Column) -> Column:
    """Metadata map of an entry row; numbers are decimal text."""
    where = place_keys()
    about = [
        F.lit(FILE_ID), F.coalesce(F.col("id"), F.lit("")),
        F.lit(FILE_SIZE), F.coalesce(F.col("size").cast("string"), F.lit("0")),
        F.lit(FILE_HASH), F.coalesce(F.col("content_hash"), F.lit("")),
    ]
    chunk = [
        F.lit(CHUNK_INDEX), index.cast("string"),
        F.lit(CHUNK_COUNT), count.cast("string"),
        F.lit(FILE_CHUNKED), F.lit("true"),
    ]
    return (
        F.when(kind == "delete", F.create_map(*where))
        .when(kind == "full", F.create_map(*where, *about))
        .otherwise(F.create_map(*where, *about, *chunk))
    )


def cut_payloads(entries: DataFrame, chunk_size: int) -> DataFrame:
    """Payload rows of routed entries that carry ``content``, in one pass.

    One row per delete and whole file, one per chunk of a larger file; adds
    kind, chunk_count, chunk_index (null unless chunked) and data.
    """
    kind, size = F.col("kind"), F.col("size")

    def single(data: Column) -> Column:
        return F.array(F.struct(F.lit(None).cast("long").alias("chunk_index"), data.alias("data")))

    payloads = (
        F.when(kind == "delete", single(F.lit(None).cast("binary")))
        .when(kind == "full", single(F.coalesce(F.col("content"), F.lit(b""))))
        .otherwise(pieces(F.col("content"), size, chunk_size))
    )
    routed = route(entries, chunk_size).where(kind != "dropped")
    keep = [c for c in routed.columns if c != "content"]
    return routed.select(
        *keep,
        F.when(kind == "chunked", chunk_count(size, chunk_size)).alias("chunk_count"),
        F.inline(payloads),
    )


def payload_records(rows: DataFrame, cursor: Column, mark: Column | None = None) -> DataFrame:
    """Records of payload rows.

    ``cursor`` is what a position resumes from; ``mark`` is the last-processed
    time (nanoseconds) before the entry, used while a file is unfinished.
    Order inside a path is (seq, chunk_index).
    """
    kind = F.col("kind")
    mark = F.lit(0).cast("long") if mark is None else mark
    return rows.select(
        "seq",
        "chunk_index",
        "chunk_count",
        record_position(cursor, mark).alias("position"),
        F.when(kind == "delete", DELETE).otherwise(CREATE).alias("operation"),
        metadata(kind, F.col("chunk_index"), F.col("chunk_count")).alias("metadata"),
        F.struct(F.col("path").alias("file_path")).alias("key"),
        F.lit(None).cast("binary").alias("payload_before"),
        F.col("data").alias("payload_after"),
    )


def to_records(
    entries: DataFrame, chunk_size: int, cursor: Column, mark: Column | None = None
) -> DataFrame:
    """Delete, full and chunk records of entries whose content is in the table."""
    return payload_records(cut_payloads(entries, chunk_size), cursor, mark)


def record_position(cursor: Column, mark: Column) -> Column:
    """Position after a record; a file counts as processed with its last chunk."""
    kind, index, count = F.col("kind"), F.col("chunk_index"), F.col("chunk_count")
    info = chunk_info(F.col("id"), F.col("path"), index, count)
    done = (kind == "full") | ((kind == "chunked") & (index == count))
    last = F.when(done, unix_nanos(F.col("server_modified"))).otherwise(mark)
    return encode_position(cursor, info, last)


def delete_records(entries: DataFrame) -> DataFrame:
    """Delete records of the tombstones; no payload, id, size or hash."""
    gone = entries.where(F.col("tag") == TAG_DELETED)
    return gone.select(
        "seq",
        F.lit(DELETE).alias("operation"),
        F.create_map(*place_keys()).alias("metadata"),
        F.struct(F.col("path").alias("file_path")).alias("key"),
        F.lit(None).cast("binary").alias("payload_after"),
    )


def record_json(with_payload: bool = True) -> Column:
    """Record as JSON text; payload bytes are base64 (the output record format)."""
    fields = ["position", "operation", "metadata", "key"]
    if with_payload:
        return F.to_json(
            F.struct(
                *fields,
                F.struct(
                    F.col("payload_before").alias("before"),
                    F.col("payload_after").alias("after"),
                ).alias("payload"),
            ),
            {"ignoreNullFields": "false"},
        )
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def read_json(lines: DataFrame, line: str = "value") -> DataFrame:
    """Records of JSON text, the opposite of ``record_json``; other columns stay in front.

    Adds ``position, operation, metadata, key, payload_before, payload_after``
    and ``record_error``. A line that is no such record stays as a row with its
    text in ``bad_line`` and the reason in ``record_error``: null or not JSON, an
    object or map of another type, payload that is not base64, no operation of the
    known ones, or no file path in the key; its record columns are null. Unknown
    fields are ignored, missing ones are null, and a text without payload gives
    null payloads.
    """
    # Columns that are replaced, and the text itself, go.
    added = [*RECORD_FIELDS, "record_error", "bad_line"]
    keep = [F.col(f"`{c}`") for c in lines.columns if c not in (*added, line)]
    text = F.col(f"`{line}`")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_JSON}
    parsed = lines.select(*keep, text.alias("_line"), F.from_json(text, RECORD_JSON, options).alias("_r"))
    error = (
        F.when(F.col("_r").isNull() | F.col(f"_r.{BAD_JSON}").isNotNull(), ERR_NO_RECORD)
        .when(~F.coalesce(F.col("_r.operation").isin(*OPERATIONS), F.lit(False)), ERR_NO_OPERATION)
        .when(F.col("_r.key.file_path").isNull(), ERR_NO_KEY)
    )
    sources = {name: name for name in RECORD_FIELDS[:4]} | {
        "payload_before": "payload.before", "payload_after": "payload.after"}
    fields = F.struct(
        # What was read of a torn text before it ended is no record.
        *[F.when(error.isNull(), F.col(f"_r.{source}")).alias(name) for name, source in sources.items()],
        error.alias("record_error"),
        F.when(error.isNotNull(), F.col("_line")).alias("bad_line"),
    )
    # Behind a generator the text is parsed once, not once per reference.
    return parsed.select(*keep, F.inline(F.array(fields)))


def split_records(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records of ``read_json``, and the lines that are none."""
    failed = F.col("record_error").isNotNull()
    return decoded.where(~failed).drop("record_error", "bad_line"), decoded.where(failed).drop(*RECORD_FIELDS)
