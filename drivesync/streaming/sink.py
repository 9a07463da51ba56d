"""Table sinks for streams: every micro-batch writes its own folder.

The folder is named by the query, whose id lives in its checkpoint, and the
batch. Writing a batch again replaces that folder, so a replay after a failure
adds nothing twice, and a query with another checkpoint never writes into it.
Readers see appended actions (or segments) as one table.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from drivesync.operators.destination import live_files
from drivesync.operators.dispatch import parse_records
from drivesync.operators.integrity import refuse_wrong_hashes
from drivesync.options import scope_path
from drivesync.schemas import ACTION, SESSION
from drivesync.session import NO_DATA_BATCHES, PAYLOAD_PARQUET, ROCKSDB, STATE_STORE, move_dir, remove_dir, settings

# Deletes, chunks and whole files are read apart from each other.
FOLDERS = ["failed", "action"]
# Set by Spark in the thread of a streaming query; the same after a restart.
QUERY_ID = "sql.streaming.queryId"


class StrictError(RuntimeError):
    """A batch held a record that cannot be applied."""


def write_actions(rows: DataFrame, folder: str, mode: str) -> None:
    rows.write.options(**PAYLOAD_PARQUET).mode(mode).partitionBy(*FOLDERS).parquet(folder)


def batch_folder(spark: SparkSession, folder: str, batch_id: int) -> str:
    """Folder of a micro-batch; outside of a query batches are named ``local``."""
    query = spark.sparkContext.getLocalProperty(QUERY_ID) or "local"
    return f"{folder}/batch_id={query}-{batch_id}"


def action_sink(folder: str, base: str | Column = "", strict: bool = False, verify: bool = True,
                strip_prefix: str | None = None):
    """foreachBatch function: checked records to ``folder``, in one write.

    Records that fail a check are kept apart as dead letters (``failed``), with
    ``verify`` also whole files that are not what their hash declares. With
    ``strict`` the records before the first failing one are written, and the
    batch fails; the batch is evaluated once, into a folder that readers of
    ``folder`` do not see, and shown when it is judged.
    """
    if isinstance(base, str):
        scope_path(base)

    def write(records: DataFrame, batch_id: int) -> None:
        parsed = parse_records(records, base, strip_prefix)
        parsed = refuse_wrong_hashes(parsed) if verify else parsed
        rows = parsed.withColumn("failed", F.col("error").isNotNull()).select(*ACTION.names)
        target = batch_folder(records.sparkSession, folder, batch_id)
        if not strict:
            return write_actions(rows, target, "overwrite")
        # Judged is what was written: records may not be the same when they are read again.
        judged = f"{folder}/_judged-{target.rpartition('=')[2]}"
        write_actions(rows, judged, "overwrite")
        kept = records.sparkSession.read.schema(ACTION).parquet(judged).select(*ACTION.names)
        place = F.struct("seq", F.coalesce("chunk_index", F.lit(0).cast("long")).alias("chunk"))
        first = kept.where("failed").agg(F.min_by(F.struct("seq", "error"), place), F.min(place)).first()
        if not first[0]:
            return move_dir(records.sparkSession, judged, target)
        at = F.struct(*[F.lit(v).cast("long").alias(n) for n, v in first[1].asDict().items()])
        write_actions(kept.where(place < at), target, "overwrite")
        remove_dir(records.sparkSession, judged)
        raise StrictError(f"record {first[0]['seq']}: {first[0]['error']}")

    return write


def session_sink(folder: str):
    """foreachBatch function for the output of ``track_uploads``."""
    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(batch_folder(rows.sparkSession, folder, batch_id))

    return write


def read_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """Segments reported so far: finished ones, and given-up ones, which are short of chunks."""
    return spark.read.schema(SESSION).parquet(folder).drop("batch_id")


def read_orphans(spark: SparkSession, folder: str) -> DataFrame:
    return read_sessions(spark, folder).where(F.col("have") < F.col("want"))


def start(stream: DataFrame, write, checkpoint: str, once: bool = True,
          interval: str = "30 seconds") -> StreamingQuery:
    """Run a stream into a foreachBatch sink: all that is there, or on an interval.

    With processing-time timers every batch asks for another one, so a single
    pass over what is there must not run batches without data. Given-up
    segments then show in the next pass that has data.
    """
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    wanted = {STATE_STORE: ROCKSDB, NO_DATA_BATCHES: str(not once).lower()}
    # A query keeps the settings it was started with.
    with settings(stream.sparkSession, wanted):
        return writer.start()


def read_actions(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(ACTION).parquet(folder).where(~F.col("failed")).drop("failed", "batch_id")


def read_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Dead letters: records that failed a check, with the reason."""
    return spark.read.schema(ACTION).parquet(folder).where(F.col("failed")).drop("failed", "batch_id")


def current_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files that exist after every action so far."""
    return live_files(read_actions(spark, folder))


def compact(spark: SparkSession, folder: str, out: str) -> None:
    """Write only the actions behind the live files to a new folder.

    Chunks of uploads still in progress are kept, and so are deletes, which
    may have to cancel the early chunks of one.
    """
    actions = read_actions(spark, folder)
    live = live_files(actions).select(
        "target_path", F.col("seq").alias("_seq"), F.col("hash").alias("_hash")
    )
    # Written as it comes, so the adaptive skew join may split a path.
    joined = actions.join(live, "target_path", "left")
    chunk = F.col("action") == "chunk"
    newer = F.col("_seq").isNull() | (F.col("seq") >= F.col("_seq"))
    winner = F.col("_hash") == F.col("hash")
    keep = (
        (F.col("action") == "delete")
        | (~chunk & winner & (F.col("seq") == F.col("_seq")))
        | (chunk & newer)
    )
    kept = joined.where(keep).select(*actions.columns).withColumn("failed", F.lit(False))
    # No batch has this name, so a query may go on in the new folder.
    write_actions(kept, f"{out}/batch_id=compacted", "errorifexists")
