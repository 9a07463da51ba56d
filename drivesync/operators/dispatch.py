"""Reading records at the destination: dispatch, checks, prefix acknowledgement.

Errors are a column, never an exception inside a task. Beyond the known
checks, chunk indexes outside 1..count and targets outside the base folder
are refused.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drivesync.functions.paths import clean_literal, clean_path, outside, target_path
from drivesync.schemas import (
    CHUNK_COUNT, CHUNK_INDEX, COLLECTION, DELETE, ERR_COUNT_MISSING, ERR_COUNT_PARSE, ERR_ESCAPE,
    ERR_HASH_MISSING, ERR_INDEX_MISSING, ERR_INDEX_PARSE, ERR_INDEX_RANGE, ERR_NAME_MISSING,
    ERR_SIZE_MISSING, ERR_SIZE_PARSE, FILE_CHUNKED, FILE_HASH, FILE_NAME, FILE_SIZE,
)


def meta(key: str) -> Column:
    return F.try_element_at(F.col("metadata"), F.lit(key))


def signed_number(text: Column) -> Column:
    """Decimal integer with optional sign, null when it is anything else."""
    return F.when(text.rlike(r"\A[+-]?[0-9]+\z"), text.try_cast("bigint"))


def unsigned_number(text: Column) -> Column:
    return F.when(text.rlike(r"\A[0-9]+\z"), text.try_cast("bigint"))


def action() -> Column:
    """delete before chunk before full; every other operation writes the file."""
    return (
        F.when(F.col("operation") == DELETE, "delete")
        .when(meta(FILE_CHUNKED) == "true", "chunk")
        .otherwise("full")
    )


def first_error(strict_range: bool = True) -> Column:
    """First failing check of a parsed row, null when the record is valid."""
    writes = F.col("action") != "delete"
    chunk = F.col("action") == "chunk"
    checks = [
        (chunk & meta(CHUNK_INDEX).isNull(), ERR_INDEX_MISSING),
        (chunk & F.col("chunk_index").isNull(), ERR_INDEX_PARSE),
        (chunk & meta(CHUNK_COUNT).isNull(), ERR_COUNT_MISSING),
        (chunk & F.col("chunk_count").isNull(), ERR_COUNT_PARSE),
        (writes & F.col("hash").isNull(), ERR_HASH_MISSING),
        (writes & meta(FILE_SIZE).isNull(), ERR_SIZE_MISSING),
        (writes & F.col("size").isNull(), ERR_SIZE_PARSE),
        (meta(FILE_NAME).isNull(), ERR_NAME_MISSING),
        (F.col("_escapes"), ERR_ESCAPE),
    ]
    if strict_range:
        outside = (F.col("chunk_index") < 1) | (F.col("chunk_index") > F.col("chunk_count"))
        checks.append((chunk & outside, ERR_INDEX_RANGE))
    error = F.lit(None).cast("string")
    for failed, text in reversed(checks):
        error = F.when(failed, text).otherwise(error)
    return error


def parse_records(
    records: DataFrame, base: str | Column = "", strip_prefix: str | None = None
) -> DataFrame:
    """Typed action columns next to the record: action, target_path, chunk_index,
    chunk_count, hash, size, the payload's ``length`` and ``error``.

    The collection of a record is absolute, so a replica is laid out as base
    plus the full source folder; ``strip_prefix`` removes a leading part of it.
    """
    # A folder that is the same for all records is cleaned once, not per record.
    root = F.lit(clean_literal(base)) if isinstance(base, str) else clean_path(base)
    base = F.lit(base) if isinstance(base, str) else base
    collection = meta(COLLECTION)
    if strip_prefix:
        stem = strip_prefix.rstrip("/")
        inside = (collection == stem) | F.startswith(collection, F.lit(stem + "/"))
        collection = F.when(inside, F.substring(collection, len(stem) + 1, 2**31 - 1)).otherwise(
            collection
        )
    fields = {
        "action": action(),
        "chunk_index": signed_number(meta(CHUNK_INDEX)),
        "chunk_count": signed_number(meta(CHUNK_COUNT)),
        "hash": meta(FILE_HASH),
        "size": unsigned_number(meta(FILE_SIZE)),
        "length": F.coalesce(F.octet_length("payload_after"), F.lit(0)).cast("long"),
        "target_path": target_path(base, collection, meta(FILE_NAME)),
    }
    keep = [c for c in records.columns if c not in fields and c != "error"]
    parsed = records.select(*keep, *[value.alias(name) for name, value in fields.items()])
    parsed = parsed.withColumn("_escapes", outside(F.col("target_path"), root))
    parsed = parsed.select(
        *keep, F.struct(*fields, first_error().alias("error")).alias("_parsed")
    )
    # A filter on a plain projection is pushed below it and repeats the parsing
    # once per reference; behind a generator it is evaluated once per record.
    return parsed.select(*keep, F.inline(F.array("_parsed")))


def split_errors(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows and the dead letters."""
    return parsed.where(F.col("error").isNull()), parsed.where(F.col("error").isNotNull())


def prefix_ack(parsed: DataFrame, batch: str = "batch", pos: str = "pos") -> DataFrame:
    """Per batch the number of records written before the first failing one.

    ``pos`` counts from 0 inside the batch. Only (batch, minimum, count)
    leaves a task, so a batch of any size is fine.
    """
    return parsed.groupBy(batch).agg(
        F.coalesce(
            F.min(F.when(F.col("error").isNotNull(), F.col(pos))), F.count(F.lit(1))
        ).cast("long").alias("written")
    )


def acknowledged(parsed: DataFrame, batch: str = "batch", pos: str = "pos") -> DataFrame:
    """Records a strict in-order writer gets to apply."""
    written = prefix_ack(parsed, batch, pos)
    return (
        parsed.join(written, batch)
        .where(F.col(pos) < F.col("written"))
        .drop("written")
    )
