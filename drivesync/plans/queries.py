"""The registered queries: one per operator, over whole tables.

Bytes are compared by their sha256, never returned.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drivesync.functions.hashing import block_count, content_hash
from drivesync.functions.paths import escapes_base, parent_dir, target_path
from drivesync.functions.positions import (
    chunk_info, decode_position, encode_position, unix_nanos,
)
from drivesync.operators import apply, changes, chunking, destination, digests, dispatch, integrity
from drivesync.operators import reassemble as re
from drivesync.operators.records import delete_records, read_json, record_json, to_records
from drivesync.operators.routing import route
from drivesync.plans import views
from drivesync.plans.views import BYTES_PER_BATCH, CHUNK
from drivesync.schemas import (
    ACTION, CHUNK_COUNT, CHUNK_INDEX, CHUNK_INFO, COLLECTION, FILE_CHUNKED, FILE_HASH, FILE_ID, FILE_NAME, FILE_PATH,
    FILE_SIZE, TAG_DELETED,
)
from drivesync.session import new_dir
from drivesync.sources import listing
from drivesync.streaming import sink
from drivesync.streaming.reassembly import chunk_stream, finished_uploads, track_uploads, upload_chunks

PAGE = 10
LOG_CURSOR = 500
RETAINED_FROM = 1000
COMPACTED_FROM = 300
# 2024-01-01 00:08:20 UTC in nanoseconds.
RESYNC_MARK = 1_704_067_700_000_000_000


def sha(column: str):
    return F.sha2(F.col(column), 256)


def q01_list_folder(spark: SparkSession, d: str) -> DataFrame:
    """Direct files of every language folder and (none) of every source folder."""
    files = views.drive(spark, d).select("path", "id", "size")
    folders = views.folder_entries(files).select(F.col("path").alias("folder"))
    return listing.list_folders(files, folders).select("folder", "path", "id", "size")


def q02_list_recursive(spark, d):
    files = views.drive(spark, d).select("path", "id", "size")
    folders = views.table(spark, d, "documents").select(
        F.concat(F.lit("/"), "source").alias("folder")
    )
    return listing.list_folders(files, folders, recursive=True).select(
        "folder", "path", "id", "size"
    )


def q03_list_page(spark, d):
    pages = listing.paginate(views.drive(spark, d).select("path"), PAGE)
    return pages.select("path", "page", "rn")


def q04_route(spark, d):
    routed = route(views.change_log(spark, d).select("tag", "size"), CHUNK)
    return routed.groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")
    )


def q05_full_records(spark, d):
    entries = views.hashed_drive(spark, d).withColumn("seq", F.col("doc_id"))
    rows = to_records(entries.where(F.col("size") <= CHUNK), CHUNK, F.col("seq").cast("string"))
    return rows.select(
        F.col("key.file_path").alias("path"),
        "operation",
        dispatch.unsigned_number(dispatch.meta(FILE_SIZE)).alias("size"),
        sha("payload_after").alias("payload_sha256"),
    )


def q06_chunk_plan(spark, d):
    plan = chunking.plan_chunks(views.drive(spark, d).select("path", "tag", "size"), CHUNK)
    return plan.select(
        "path", "chunk_index", "chunk_count",
        F.col("start").alias("start_byte"), F.col("end").alias("end_byte"),
    )


def q06_chunk_records(spark, d):
    chunks = chunking.cut_chunks(views.drive(spark, d).select("path", "size", "content"), CHUNK)
    return chunks.select(
        "path", "chunk_index", "chunk_count",
        F.octet_length("data").cast("long").alias("length"), sha("data").alias("payload_sha256"),
    )


def q07_verify_paths(spark, d):
    """Document folders and files, and page paths that are not there."""
    files = views.drive(spark, d).select("tag", "path")
    pages = views.table(spark, d, "pages")
    asked = files.select(parent_dir(F.col("path")).alias("path")).union(files.select("path"))
    asked = asked.union(pages.select(F.concat(F.lit("/pages/"), "page_id")))
    return listing.verify_paths(asked, files)


def q08_delete_records(spark, d):
    rows = delete_records(views.change_log(spark, d))
    return rows.select(
        "seq",
        F.col("key.file_path").alias("path"),
        "operation",
        F.col("payload_after").isNull().alias("payload_is_null"),
        F.size("metadata").cast("long").alias("n_keys"),
    )


def q09_metadata(spark, d):
    rows = views.records(spark, d)
    keys = {
        "file_name": FILE_NAME, "file_id": FILE_ID, "file_path": FILE_PATH,
        "collection": COLLECTION, "file_size": FILE_SIZE, "file_hash": FILE_HASH,
        "chunked": FILE_CHUNKED, "chunk_index": CHUNK_INDEX, "chunk_count": CHUNK_COUNT,
    }
    return rows.select(
        F.col("key.file_path").alias("path"),
        *[dispatch.meta(key).alias(f"m_{name}") for name, key in keys.items()],
    )


def q10_collection(spark, d):
    """Parent folders of the files, the folders, and the root-level page files."""
    files = views.drive(spark, d).select("path")
    pages = views.table(spark, d, "pages").select(F.concat(F.lit("/"), "page_id", F.lit(".html")))
    paths = files.union(pages).union(views.folder_entries(files).select("path"))
    return paths.select("path", parent_dir(F.col("path")).alias("collection"))


def q11_snapshot(spark, d):
    rows = views.records(spark, d)
    return rows.select(
        F.col("key.file_path").alias("path"),
        "chunk_index",
        sha("payload_after").alias("payload_sha256"),
        F.octet_length("payload_after").cast("long").alias("length"),
    )


def q12_cdc_log(spark, d):
    log = changes.changes_after(views.change_log(spark, d), LOG_CURSOR)
    routed = route(log, CHUNK).where(F.col("kind") != "dropped")
    return routed.select("seq", "path", changes.operation(F.col("tag")).alias("operation"), "kind")


def q13_cdc_diff(spark, d):
    diff = changes.diff_listings(views.old_listing(spark, d), views.new_listing(spark, d))
    return diff.select("path", "operation", "change_type", "content_hash")


def q13_diff_by_digests(spark, d):
    """The diff again, over entries of folders with unequal digests only."""
    diff = digests.diff_by_digests(views.old_listing(spark, d), views.new_listing(spark, d))
    return diff.select("path", "operation", "change_type", "content_hash")


def q13_unequal_subtrees(spark, d):
    """Folders below which the two listings differ, with their numbers of files."""
    trees = [digests.subtree_digests(digests.folder_digests(listing))
             for listing in (views.old_listing(spark, d), views.new_listing(spark, d))]
    return digests.unequal_folders(*trees)


def q14_resync(spark, d):
    files = views.drive(spark, d).select("path", "tag", "size", "server_modified")
    return route(changes.resync_since(files, RESYNC_MARK), CHUNK).select("path", "kind")


def q15_resync_decision(spark, d):
    consumers = views.table(spark, d, "conversations").select(
        F.col("conv_id").alias("consumer"), (F.col("conv_id") * 97).alias("saved")
    ).distinct()
    kept = views.change_log(spark, d).where(F.col("seq") >= RETAINED_FROM)
    return changes.resume_decision(consumers, kept)


def q15_resume_compacted(spark, d):
    """The decision where trimmed changes are kept in compacted form from a position on."""
    consumers = views.table(spark, d, "conversations").select(
        F.col("conv_id").alias("consumer"), (F.col("conv_id") * 97).alias("saved")
    ).distinct()
    kept = views.change_log(spark, d).where(F.col("seq") >= RETAINED_FROM)
    return changes.resume_decision(consumers, kept, COMPACTED_FROM)


def q15_compacted_apply(spark, d):
    """A consumer at a trimmed position ends like one that has read the whole log."""
    log = views.change_log(spark, d).where(F.col("tag") != "folder").select("path", "seq", "value", "tag")
    held = log.where(F.col("seq") <= LOG_CURSOR)
    trimmed = changes.compact_log(log.where(F.col("seq") < RETAINED_FROM))
    missed = changes.changes_after(trimmed, LOG_CURSOR).union(log.where(F.col("seq") >= RETAINED_FROM))
    events = held.union(missed).select("path", "seq", "value", (F.col("tag") == TAG_DELETED).alias("deleted"))
    return apply.apply_latest(events)


def q15_resync_apply(spark, d):
    """A consumer of listing A whose position expired ends with listing B."""
    held = views.old_listing(spark, d).select("path", "content_hash")
    missed = changes.resync_changes(views.new_listing(spark, d), held, RETAINED_FROM)
    events = held.select(
        "path", "content_hash", F.lit(0).cast("long").alias("seq"), F.lit(False).alias("deleted")
    ).union(missed.select("path", "content_hash", "seq", F.col("tag") == TAG_DELETED))
    return apply.apply_latest(events).select("path", "content_hash")


def _positions(spark, d):
    plan = chunking.plan_chunks(
        views.drive(spark, d).drop("content", "name"), CHUNK
    )
    index, count = F.col("chunk_index"), F.col("chunk_count")
    last = F.when(index == count, unix_nanos(F.col("server_modified"))).otherwise(F.lit(0))
    return plan.select(
        "path",
        "chunk_index",
        encode_position(
            F.col("doc_id").cast("string"),
            chunk_info(F.col("id"), F.col("path"), index, count),
            last.cast("long"),
        ).alias("position"),
    )


def q16_position(spark, d):
    return _positions(spark, d)


def q16_position_parse(spark, d):
    parsed = _positions(spark, d).withColumn("p", decode_position(F.col("position")))
    return parsed.select(
        "path",
        "chunk_index",
        F.col("p.cursor").alias("cursor"),
        F.col("p.chunk_info.file_id").alias("file_id"),
        F.col("p.chunk_info.chunk_index").alias("saved_index"),
        F.col("p.last_processed_unix_time").alias("last_processed"),
    )


def q17_resume(spark, d):
    saved = views.table(spark, d, "labels").select(
        F.concat(F.lit("id:"), "doc_id").alias("id"),
        (F.col("quality") + F.col("toxic") + 1).cast("long").alias("saved_index"),
    )
    files = views.drive(spark, d).select("id", "path", "tag", "size")
    return chunking.plan_chunks(files, CHUNK, saved).select("path", "chunk_index", "chunk_count")


def q18_last_processed(spark, d):
    log = views.change_log(spark, d).select("seq", "tag", "server_modified")
    marks = changes.last_processed(log, 500, first=0)
    return marks.select(
        "batch", unix_nanos(F.col("newest")).alias("newest"), unix_nanos(F.col("mark")).alias("mark")
    )


def q19_microbatch(spark, d):
    log = views.change_log(spark, d).select("seq")
    return log.groupBy(changes.micro_batch(F.col("seq"), 100, 0).alias("batch")).agg(
        F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq")
    )


def q19_byte_batches(spark, d):
    """Micro-batches of the change log admitted by payload bytes."""
    batches = changes.byte_batches(views.change_log(spark, d), BYTES_PER_BATCH)
    return batches.groupBy("batch").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
        F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"),
    )


def q21_dispatch(spark, d):
    """Records of the drive plus the deletes of the change log."""
    writes = views.records(spark, d).select("operation", "metadata")
    gone = delete_records(views.change_log(spark, d)).select("operation", "metadata")
    return writes.union(gone).groupBy(dispatch.action().alias("action")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _parsed_faulty(spark, d):
    """Damaged records with ``pos``, their true place among their file's records."""
    place = F.coalesce("chunk_index", F.lit(1).cast("long")) - 1
    return dispatch.parse_records(views.faulty_records(spark, d).withColumn("pos", place))


def q22_prefix_ack(spark, d):
    """The records of a file are one batch."""
    rows = _parsed_faulty(spark, d).select(F.col("key.file_path").alias("batch"), "pos", "error")
    return dispatch.prefix_ack(rows)


def q23_validate(spark, d):
    rows = _parsed_faulty(spark, d)
    return rows.select(F.col("key.file_path").alias("path"), "pos", "action", "error")


def q24_target_path(spark, d):
    """Untidy collections: doubled slashes, '.' and '..', one climbing above the root."""
    docs = views.table(spark, d, "documents")
    untidy = (
        F.when(F.col("lang") == "en", F.concat(F.lit("/"), "source", F.lit("//./en")))
        .when(F.col("lang") == "de", F.concat("source", F.lit("/x/../de/")))
        .when(F.col("lang") == "fr", F.concat(F.lit("/../../"), "source", F.lit("/fr")))
        .otherwise(F.concat(F.lit("/"), "source", F.lit("/es")))
    )
    rows = docs.select(
        F.lit("/replica").alias("base"),
        untidy.alias("collection"),
        F.concat("doc_id", F.lit(".txt")).alias("filename"),
    )
    path = target_path(F.col("base"), F.col("collection"), F.col("filename"))
    return rows.select("base", "collection", "filename", path.alias("target")).withColumn(
        "escapes", escapes_base(F.col("target"), F.col("base"))
    )


def q25_apply_latest(spark, d):
    log = views.change_log(spark, d).where(F.col("tag") != "folder")
    events = log.select("path", "seq", "value", (F.col("tag") == "deleted").alias("deleted"))
    return apply.apply_latest(events)


def _chunks_of(files):
    chunks = chunking.cut_chunks(
        files.select("doc_id", "path", "size", "content_hash", "content"), CHUNK
    )
    return chunks.select(
        F.col("path").alias("target_path"),
        F.col("content_hash").alias("hash"),
        "chunk_count", "chunk_index", "size", F.col("doc_id").alias("seq"), "data",
    )


def _stored(spark, parts, label):
    """Segments as the destination keeps them: written once, then read by column."""
    folder = new_dir(spark, label)
    re.store_segments(parts, folder)
    return re.read_segments(spark, folder)


def q26_reassemble(spark, d):
    """Files from their chunks, hashed in 4 KiB blocks across segment borders."""
    parts = _stored(spark, re.segments(_chunks_of(views.hashed_drive(spark, d))), "q26")
    hashes = re.hash_segments(parts, 4096)
    files = re.manifest(parts)
    return files.join(hashes, re.FILE_KEY).select(
        F.col("target_path").alias("path"),
        "bytes", "status", "n_blocks", F.col("content_hash").alias("block_hash"),
    )


def _arriving(spark, d):
    """Chunk lengths in arrival order: French files come last chunk first."""
    plan = chunking.plan_chunks(
        views.drive(spark, d).select("doc_id", "path", "lang", "tag", "size"), CHUNK
    )
    place = F.when(F.col("lang") == "fr", F.col("chunk_count") - F.col("chunk_index")).otherwise(
        F.col("chunk_index") - 1
    )
    return plan.select(
        F.col("path").alias("target_path"),
        F.col("path").alias("hash"),
        "chunk_count", "chunk_index",
        (F.col("end") - F.col("start")).alias("length"),
        (F.col("doc_id") * 1_000_000 + place).alias("arrival"),
    )


def q27_session_offsets(spark, d):
    rows = re.session_offsets(_arriving(spark, d))
    return rows.select(
        F.col("target_path").alias("path"), "chunk_index", "append_offset", "missing_session"
    )


def q28_incomplete(spark, d):
    """Labelled files lost chunks: toxic ones the first, low-quality ones the last."""
    plan = chunking.plan_chunks(
        views.drive(spark, d).select("doc_id", "path", "tag", "size"), CHUNK
    ).join(views.table(spark, d, "labels"), "doc_id", "left")
    first = (F.col("toxic") == 1) & (F.col("chunk_index") == 1)
    last = (F.col("quality") == 0) & (F.col("chunk_index") == F.col("chunk_count"))
    came = plan.where(~F.coalesce(first | last, F.lit(False))).select(
        F.col("path").alias("target_path"),
        F.col("path").alias("hash"),
        "chunk_count", "chunk_index", "size",
        F.col("doc_id").alias("seq"),
        (F.col("end") - F.col("start")).alias("length"),
    )
    return re.incomplete_files(came).select(
        F.col("target_path").alias("path"), "have", F.col("chunk_count").alias("want"), "bytes"
    )


def q29_stream_reassemble(spark, d):
    """The drive's chunks as a stream: staged once, tracked in checkpointed state, read when complete."""
    schema = views.table(spark, d, "documents").schema
    # A glob, so that the table may be one file or a folder of them.
    documents = spark.readStream.schema(schema).parquet(f"{d}/documents.parque[t]")
    files = views.drive_of(documents).withColumn("content_hash", content_hash(F.col("content")))
    chunks = _chunks_of(files).withColumnRenamed("data", "payload_after").withColumns({
        "action": F.lit("chunk"), "length": F.octet_length("payload_after").cast("long"),
        "error": F.lit(None).cast("string"), "failed": F.lit(False),
    })
    work = new_dir(spark, "q29")
    actions, sessions = f"{work}/actions", f"{work}/sessions"

    def stage(rows, batch_id):
        sink.write_actions(rows.select(*ACTION.names), sink.batch_folder(rows.sparkSession, actions, batch_id), "overwrite")

    sink.start(chunks, stage, f"{work}/staging").awaitTermination()
    sink.start(track_uploads(chunk_stream(spark, actions)), sink.session_sink(sessions), f"{work}/tracking").awaitTermination()
    finished = finished_uploads(sink.read_sessions(spark, sessions))
    parts = _stored(spark, re.segments(upload_chunks(sink.read_actions(spark, actions), finished)), "q29")
    return re.manifest(parts).join(re.hash_segments(parts), re.FILE_KEY).select(
        F.col("target_path").alias("path"), "bytes", "status", "content_hash"
    )


def q30_integrity(spark, d):
    """Declared size is the character count: wrong for every multi-byte file."""
    files = views.drive_of(views.table(spark, d, "documents"), "n_chars")
    return integrity.check_sizes(files.select("path", F.col("n_chars").alias("declared"), "content"))


def q31_delete_prefix(spark, d):
    """Folders of toxic documents deleted when those arrive, whole sources for toxic low-quality ones."""
    files = views.drive(spark, d).select("path", F.col("doc_id").alias("seq"), F.col("source"), F.col("lang"))
    toxic = files.join(
        views.table(spark, d, "labels").where(F.col("toxic") == 1).withColumnRenamed("doc_id", "seq"),
        "seq",
    )
    deletes = toxic.select(
        F.when(F.col("quality") == 0, F.concat(F.lit("/"), "source"))
        .otherwise(F.concat(F.lit("/"), "source", F.lit("/"), "lang")).alias("path"),
        "seq",
    )
    return apply.drop_deleted_subtrees(files.select("path", "seq"), deletes)


def q33_record_json(spark, d):
    position = encode_position(
        F.col("seq").cast("string"), F.lit(None).cast(CHUNK_INFO), F.lit(0).cast("long")
    )
    rows = delete_records(views.change_log(spark, d)).withColumn("position", position)
    return rows.select("seq", record_json(with_payload=False).alias("record"))


def q33_read_json(spark, d):
    """Every record as JSON and back, payload included; the lines of one source are cut in half."""
    lines = views.records(spark, d).select(F.col("key.file_path").alias("path"), record_json().alias("line"))
    torn = F.split("path", "/")[1] == views.BAD_HASH
    half = F.expr("left(line, int(length(line) div 2))")
    rows = read_json(lines.withColumn("line", F.when(torn, half).otherwise(F.col("line"))), "line")
    return rows.select(
        "path", "operation", F.col("key.file_path").alias("file_path"),
        dispatch.signed_number(dispatch.meta(CHUNK_INDEX)).alias("chunk_index"),
        dispatch.meta(FILE_HASH).alias("file_hash"), sha("payload_after").alias("payload_sha256"), "record_error",
    )


def q34_block_hash(spark, d):
    files = views.drive(spark, d)
    return files.select(
        "path",
        block_count(F.col("size"), CHUNK).alias("n_blocks"),
        content_hash(F.col("content"), CHUNK).alias("block_hash"),
    )


def q34_verify_hashes(spark, d):
    """Stored files against declared hashes; those of one source declare another's content."""
    files = views.records(spark, d)
    damaged = F.split("key.file_path", "/")[1] == views.BAD_HASH
    other = F.transform_values(
        "metadata", lambda key, value: F.when(damaged & (key == FILE_HASH), F.sha2(value, 256)).otherwise(value)
    )
    parsed = dispatch.parse_records(files.withColumn("metadata", other))
    parts = _stored(spark, destination.stored_segments(parsed), "q34")
    checked = integrity.verify_hashes(re.hash_segments(parts))
    return checked.select(F.col("target_path").alias("path"), "content_hash", "ok")


def q35_sync_report(spark, d):
    files = views.drive(spark, d).select("size", parent_dir(F.col("path")).alias("collection"))
    return integrity.sync_report(files, CHUNK)


def q35_sync_outcomes(spark, d):
    """Damaged records of the drive and the deletes of the change log, per collection."""
    gone = dispatch.parse_records(delete_records(views.change_log(spark, d)))
    columns = ["key", "action", "error", "length"]
    rows = _parsed_faulty(spark, d).select(columns).union(gone.select(columns))
    return integrity.sync_outcomes(rows, parent_dir(F.col("key.file_path")))


def q36_roundtrip(spark, d):
    """Every file through records, checks, reassembly and hashing, against the original."""
    parsed = dispatch.parse_records(views.records(spark, d))
    parts = _stored(spark, destination.stored_segments(parsed), "q36")
    complete = re.manifest(parts).where(F.col("status") == "complete")
    hashes = re.hash_segments(parts)
    stored = complete.select(*re.FILE_KEY, "bytes").join(hashes, re.FILE_KEY).select(
        F.col("target_path").alias("path"), F.col("bytes").alias("size"), "content_hash"
    )
    source = views.hashed_drive(spark, d).select("path", "size", "content_hash")
    return integrity.compare_files(source, stored)


QUERIES = {
    name: run for name, run in list(globals().items()) if name[0] == "q" and name[1:3].isdigit()
}
