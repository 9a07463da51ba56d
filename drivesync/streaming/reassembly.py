"""Which uploads are complete, from a stream of chunk actions.

Payload is staged once, in the action table. The stream reads only its slim
columns, and the state of a segment of a file is a bitmap of the chunks that
are there, with byte count and positions: a few numbers, whatever the chunks
hold. Sessions survive a restart, chunks may come in any order and again, a
single-chunk file completes at once, and segments that stay unfinished are
given up after a time and reported. Content is read from the action table when
a file is complete.
"""

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from drivesync.operators.reassemble import FILE_KEY, SEGMENT_CHUNKS, segment_of
from drivesync.schemas import ACTION, SESSION

DEFAULT_TTL_MS = 24 * 60 * 60 * 1000
# Of an upload in progress. The newest position of one already reported is a state of its own.
STATE = "present bigint, bytes bigint, seq bigint, last_seq bigint, size bigint"


class UploadTracker(StatefulProcessor):
    """Emits a segment once when its chunks are all there, or its loss on timeout."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle):
        self.handle = handle
        self.session = handle.getValueState("session", STATE)
        # Outlives the timer that gives waiting chunks up.
        self.sent = handle.getValueState("sent", "seq bigint", 2 * self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        (sent,) = self.sent.get() or (None,)
        present, size_sum, seq, last, size = self.session.get() or (0, 0, None, None, None)
        waiting = present
        for row in rows:
            # Copies of an upload already reported are no new one.
            if sent is not None and row.seq <= sent:
                continue
            bit = 1 << ((row.chunk_index - 1) % SEGMENT_CHUNKS)
            if not present & bit:
                present |= bit
                size_sum += row.length
            seq = row.seq if seq is None else min(seq, row.seq)
            if last is None or row.seq >= last:
                last, size = row.seq, row.size
        if not present:
            return
        if present.bit_count() < wanted(key):
            if not waiting:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.ttl_ms)
            self.session.update((present, size_sum, seq, last, size))
            return
        if waiting:
            self.forget()
        self.sent.update((last,))
        yield session_row(key, present, size_sum, seq, last, size)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = self.session.get()
        if held:
            self.forget()
            yield session_row(key, *held)

    def forget(self):
        self.session.clear()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)

    def close(self):
        pass


def wanted(key) -> int:
    _, _, count, segment = key
    return min(count - segment * SEGMENT_CHUNKS, SEGMENT_CHUNKS)


def session_row(key, present, size_sum, seq, last, size) -> Row:
    return Row(
        target_path=key[0], hash=key[1], chunk_count=key[2], segment=key[3], have=present.bit_count(),
        want=wanted(key), bytes=size_sum, seq=seq, last_seq=last, size=size,
    )


def chunk_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Chunk actions of an action table as a stream, without their payload."""
    actions = spark.readStream.schema(ACTION).parquet(folder)
    return actions.where(~F.col("failed") & (F.col("action") == "chunk")).select(
        *FILE_KEY, "chunk_index", "size", "seq", "length")


def track_uploads(chunks: DataFrame, ttl_ms: int = DEFAULT_TTL_MS) -> DataFrame:
    """Finished segments of a ``chunk_stream``, and those given up after ``ttl_ms`` (``have`` < ``want``).

    ``bytes`` counts the first copy of each chunk. Needs the RocksDB state
    store (``session.STATE_STORE``).
    """
    return (
        chunks.withColumn("segment", segment_of(F.col("chunk_index")))
        .groupBy(*FILE_KEY, "segment")
        .transformWithState(UploadTracker(ttl_ms), SESSION, "append", "processingTime")
    )


def finished_uploads(sessions: DataFrame) -> DataFrame:
    """``FILE_KEY, last_seq`` of the files all of whose segments are reported as finished."""
    done = sessions.where(F.col("have") == F.col("want")).groupBy(*FILE_KEY, "segment").agg(
        F.max("have").alias("have"), F.max("last_seq").alias("last_seq"))
    files = done.groupBy(*FILE_KEY).agg(F.sum("have").alias("have"), F.max("last_seq").alias("last_seq"))
    return files.where(F.col("have") == F.col("chunk_count")).drop("have")


def upload_chunks(actions: DataFrame, finished: DataFrame) -> DataFrame:
    """Chunks with payload of finished uploads, as ``reassemble.segments`` takes them."""
    chunks = actions.where(F.col("action") == "chunk").withColumnRenamed("payload_after", "data")
    joined = chunks.join(finished.withColumnRenamed("last_seq", "_last"), FILE_KEY)
    return joined.where(F.col("seq") <= F.col("_last")).select(*FILE_KEY, "chunk_index", "size", "seq", "data")
