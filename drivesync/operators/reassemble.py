"""Chunk records back to files.

A file is rebuilt in *segments* of a fixed number of consecutive chunks, so a
cell or task never holds more than ``SEGMENT_CHUNKS`` chunks, however large
the file is; files below that size are one segment. Chunks may come in any
order and more than once. A file is complete when all of 1..count are there;
files are told apart by target path, hash and count, so equal content at two
paths does not mix.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drivesync.functions.hashing import block_count, content_hash
from drivesync.functions.numbers import int_div
from drivesync.operators.skew import are_few, running
from drivesync.schemas import ERR_CORRUPT, HASH_BLOCK, STORED_SEGMENT
from drivesync.session import PAYLOAD_PARQUET, shared_dir

FILE_KEY = ["target_path", "hash", "chunk_count"]
# 16 chunks of the default 3.75 MiB are 60 MiB.
SEGMENT_CHUNKS = 16


def segment_of(index):
    return int_div(index - 1, SEGMENT_CHUNKS)


def segments(chunks: DataFrame) -> DataFrame:
    """Segments of ``chunks(target_path, hash, chunk_count, chunk_index, size, seq, data)``.

    A segment row has its chunk number ``have``, ``want``, ``bytes``, and the
    ``content`` of its chunks in order. Of a chunk sent more than once the
    latest copy is taken.

    Each place in the segment is an aggregate of its own. Copies collapse in
    front of the one shuffle, a huge file spreads over its segments, and the
    sort-based aggregation this leads to holds one segment at a time (a
    collect_list would hold up to 128 in its hash map).
    """
    places = range(SEGMENT_CHUNKS)
    place = (F.col("chunk_index") - 1) % SEGMENT_CHUNKS
    rows = chunks.withColumns({"segment": segment_of(F.col("chunk_index")), "_place": place})
    at = [F.when(F.col("_place") == i, F.col("seq")) for i in places]
    grouped = rows.groupBy(*FILE_KEY, "segment").agg(
        *[F.max(at[i]).alias(f"_seq{i}") for i in places],
        *[F.max_by("data", at[i]).alias(f"_data{i}") for i in places],
        F.max("seq").alias("last_seq"),
        F.max_by("size", "seq").alias("size"),
    )
    seqs = [F.col(f"_seq{i}") for i in places]
    datas = [F.coalesce(f"_data{i}", F.lit(b"")) for i in places]
    content = F.concat(*datas)
    return grouped.select(
        *FILE_KEY,
        "segment",
        sum((s.isNotNull().cast("long") for s in seqs[1:]), seqs[0].isNotNull().cast("long")).alias("have"),
        segment_want().alias("want"),
        sum((F.octet_length(d) for d in datas[1:]), F.octet_length(datas[0])).cast("long").alias("bytes"),
        F.least(*seqs).alias("seq"),
        "last_seq",
        "size",
        content.alias("content"),
    )


def segment_want():
    """Chunks a segment has when complete."""
    rest = F.col("chunk_count") - F.col("segment") * SEGMENT_CHUNKS
    return F.least(rest, F.lit(SEGMENT_CHUNKS).cast("long"))


def manifest(parts: DataFrame) -> DataFrame:
    """One row per file from its segments (or chunks): counts, bytes, status.

    status is incomplete, corrupt (stored bytes differ from the declared size)
    or complete; ``error`` names both sizes of a corrupt file. ``seq`` is the
    oldest among the latest copies of the chunks, so an upload that was sent
    again counts as new only when all of it came again, and a delete or write
    in the middle of an upload beats it.
    """
    files = parts.groupBy(*FILE_KEY).agg(
        F.sum("have").cast("long").alias("have"),
        F.sum("bytes").cast("long").alias("bytes"),
        F.min("seq").alias("seq"),
        F.max("last_seq").alias("last_seq"),
        F.max("size").alias("size"),
    )
    status = (
        F.when(F.col("have") < F.col("chunk_count"), "incomplete")
        .when(F.col("bytes") != F.col("size"), "corrupt")
        .otherwise("complete")
    )
    return files.withColumn("status", status).withColumn(
        "error",
        F.when(
            F.col("status") == "corrupt",
            F.format_string(f"{ERR_CORRUPT}: stored %d, declared %d", "bytes", "size"),
        ),
    )


def chunk_manifest(chunks: DataFrame) -> DataFrame:
    """Manifest straight from chunk rows with ``length``; reads no payload.

    Two aggregates over integers, each combined before its shuffle.
    """
    once = chunks.groupBy(*FILE_KEY, "chunk_index").agg(
        F.max_by("length", "seq").alias("bytes"),
        F.max("seq").alias("seq"),
        F.max_by("size", "seq").alias("size"),
    )
    return manifest(
        once.withColumns({"have": F.lit(1).cast("long"), "last_seq": F.col("seq")})
    )


def incomplete_files(chunks: DataFrame, before_seq: int | None = None) -> DataFrame:
    """Files with missing chunks; ``before_seq`` keeps those idle since then (orphans)."""
    open_files = chunk_manifest(chunks).where(F.col("status") == "incomplete")
    if before_seq is not None:
        open_files = open_files.where(F.col("last_seq") < before_seq)
    return open_files


def session_offsets(chunks: DataFrame) -> DataFrame:
    """Append offset of each chunk when chunks are applied strictly as they come.

    A chunk with index 1 opens the session of its file and the last index
    closes it; a chunk in between appends at the bytes written so far. A
    chunk without an open session has no offset and ``missing_session`` set.
    ``arrival`` orders the chunks; a file of any size is summed in blocks.
    """
    key = ["target_path", "hash"]
    shared_dir(chunks.sparkSession)
    # Kept (no payload in it): the second pass reads it twice.
    opened = running(
        chunks.withColumn("_open", (F.col("chunk_index") == 1).cast("long")),
        key, "arrival", {"session": ("sum", "_open")},
    ).checkpoint()
    closes = (F.col("chunk_index") > 1) & (F.col("chunk_index") == F.col("chunk_count"))
    summed = running(
        opened.withColumn("_close", closes.cast("long")),
        [*key, "session"], "arrival",
        {"_before": ("sum", "length"), "_closed": ("sum", "_close")},
        inclusive=False,
    )
    missing = (F.col("session") == 0) | (F.col("_closed") > 0)
    return summed.withColumn("missing_session", missing).withColumn(
        "append_offset", F.when(~missing, F.col("_before").cast("long"))
    ).drop("_open", "_close", "_before", "_closed", "session")


def store_segments(parts: DataFrame, folder: str) -> None:
    """Write segments; files of one segment and of several go to folders of their own,
    so that a reader of one kind does not scan the other.
    """
    multi = F.col("chunk_count") > SEGMENT_CHUNKS
    parts.withColumn("multi", multi).write.options(**PAYLOAD_PARQUET).mode(
        "overwrite"
    ).partitionBy("multi").parquet(folder)


def read_segments(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(STORED_SEGMENT).parquet(folder)


def segment_offsets(parts: DataFrame) -> DataFrame:
    """Byte ``offset`` of each segment in its file; rows (file key, segment, offset)."""
    narrow = parts.select(*FILE_KEY, "segment", "bytes")
    return running(
        narrow, FILE_KEY, "segment", {"offset": ("sum", "bytes")}, inclusive=False
    ).drop("bytes")


def hash_segments(parts: DataFrame, block: int = HASH_BLOCK) -> DataFrame:
    """Content hash of every file in a stored segment table."""
    return hash_placed(place_segments(parts), block)


def hash_placed(placed: DataFrame, block: int = HASH_BLOCK) -> DataFrame:
    """Content hash of every file from its segments with ``offset``.

    Content of one segment is hashed where it is. Segments of larger files are
    cut at block borders: a block inside one segment is hashed in place, and
    only its digest moves; a block over two segments is put together first, at
    most ``block`` bytes. The digests of a file are joined in two steps; they
    are 1/131072 of its bytes at 4 MiB blocks. Hashes of incomplete files mean
    nothing, see ``manifest``.
    """
    single = placed.where(~F.col("multi")).select(
        *FILE_KEY,
        block_count(F.col("bytes"), block).alias("n_blocks"),
        content_hash(F.col("content"), block).alias("content_hash"),
    )
    return single.unionByName(hash_blocks(placed.where(F.col("multi")), block))


def uneven_files(parts: DataFrame) -> DataFrame:
    """Keys of whole files whose chunks are not all equally long up to the last,
    or not of the declared size together. Reads no payload."""
    last = segment_of(F.col("chunk_count"))
    body = F.when(F.col("segment") < last, F.col("bytes"))
    files = parts.groupBy(*FILE_KEY).agg(
        F.sum("have").alias("have"), F.sum("bytes").alias("bytes"),
        F.min(body).alias("shortest"), F.max(body).alias("longest"),
        F.min("size").alias("least"), F.max("size").alias("size"),
    )
    even = (
        (F.col("shortest") == F.col("longest"))
        & (F.col("bytes") == F.col("size")) & (F.col("least") == F.col("size"))
    )
    whole = F.col("have") == F.col("chunk_count")
    return files.where(whole & ~even).select(*FILE_KEY)


def place_segments(parts: DataFrame) -> DataFrame:
    """Stored segments with their byte ``offset``.

    A source cuts a file into equal chunks, so a row tells its offset itself:
    the last segment ends with the file, the others are equally long. Files of
    other producers that are not cut so get offsets summed over their segments,
    and only their rows go through a join for it. Offsets of incomplete files
    mean nothing.
    """
    spark = parts.sparkSession
    shared_dir(spark)
    ends = F.greatest(F.col("size") - F.col("bytes"), F.lit(0).cast("long"))
    offset = (
        F.when(F.col("segment") == 0, F.lit(0).cast("long"))
        .when(F.col("segment") < segment_of(F.col("chunk_count")), F.col("segment") * F.col("bytes"))
        .otherwise(ends)
    )
    placed = parts.withColumn("offset", offset)
    uneven = uneven_files(parts.where(F.col("multi"))).checkpoint()
    if uneven.isEmpty():
        return placed
    keys = F.broadcast(uneven) if are_few(uneven) else uneven
    rows = parts.where(F.col("multi")).join(keys, FILE_KEY, "left_semi")
    summed = rows.join(segment_offsets(rows), [*FILE_KEY, "segment"])
    return placed.join(keys, FILE_KEY, "left_anti").unionByName(summed)


def hash_blocks(placed: DataFrame, block: int) -> DataFrame:
    """Content hash of files from segments with ``offset``, block by block.

    At the default chunk size (and any other of which 16 make whole blocks)
    segments end on block borders, and nothing but digests moves.
    """
    run_blocks = 4096
    first = int_div(F.col("offset"), block)
    last = int_div(F.col("offset") + F.greatest(F.col("bytes") - 1, F.lit(0)), block)

    def cut(b):
        begin = F.greatest(b * F.lit(block), F.col("offset"))
        stop = F.least((b + 1) * F.lit(block), F.col("offset") + F.col("bytes"))
        data = F.substring(
            F.col("content"),
            (begin - F.col("offset") + 1).cast("int"),
            (stop - begin).cast("int"),
        )
        whole = (begin == b * F.lit(block)) & (
            (stop == (b + 1) * F.lit(block)) | (stop == F.col("size"))
        )
        return F.struct(
            b.alias("b"),
            begin.alias("at"),
            F.when(whole, F.sha2(data, 256)).alias("digest"),
            F.when(~whole, F.hex(data)).alias("loose"),
        )

    pieces = placed.select(*FILE_KEY, F.inline(F.transform(F.sequence(first, last), cut)))
    blocks = pieces.groupBy(*FILE_KEY, "b").agg(
        F.max("digest").alias("_whole"),
        F.sort_array(
            F.collect_list(F.when(F.col("loose").isNotNull(), F.struct("at", "loose")))
        ).alias("_loose"),
    )
    glued = F.unhex(F.array_join(F.col("_loose")["loose"], ""))

    def digests(order):
        items = F.sort_array(F.collect_list(F.struct(order, "digest")))
        return F.array_join(items["digest"], "")

    runs = (
        blocks.select(*FILE_KEY, "b", F.coalesce("_whole", F.sha2(glued, 256)).alias("digest"))
        .groupBy(*FILE_KEY, int_div(F.col("b"), run_blocks).alias("run"))
        .agg(digests("b").alias("digest"), F.count(F.lit(1)).alias("n"))
    )
    return runs.groupBy(*FILE_KEY).agg(
        F.sum("n").cast("long").alias("n_blocks"),
        F.sha2(F.unhex(digests("run")), 256).alias("content_hash"),
    )
