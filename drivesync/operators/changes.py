"""Change capture: cursors over a change log, listing diffs, resync.

Differences to a plain cursor client, all deliberate: an offset moves only
when its batch is committed; the resync time filter holds for every page, not
just the first; the last-processed mark never moves back; and a resync by
diff also finds what was deleted while the cursor was invalid.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drivesync.functions.numbers import int_div
from drivesync.functions.paths import base_name
from drivesync.operators.apply import latest_per_path
from drivesync.operators.routing import is_file
from drivesync.operators.skew import running
from drivesync.options import check_positive
from drivesync.schemas import CREATE, DELETE, TAG_DELETED
from drivesync.sources.listing import number_rows


def changes_after(log: DataFrame, cursor: int) -> DataFrame:
    """Log rows behind the cursor; the filter reaches the scan."""
    return log.where(F.col("seq") > cursor)


def operation(tag: Column) -> Column:
    """Record operation of a change; new and modified files are both creates."""
    return F.when(F.coalesce(tag, F.lit("")) == TAG_DELETED, DELETE).otherwise(CREATE)


def diff_listings(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changes that turn listing ``old`` into ``new``, one row per changed path.

    Listings hold one row per path, so the join key is never hot. Output: the
    entry columns of the new state (old state for deletes), tag ``deleted``
    for deletes, ``operation`` and the finer ``change_type``.
    """
    columns = [c for c in new.columns if c != "path"]
    a = old.select("path", F.struct(*columns).alias("_old"))
    b = new.select("path", F.struct(*columns).alias("_new"))
    change = (
        F.when(F.col("_old").isNull(), "create")
        .when(F.col("_new").isNull(), "delete")
        .when(~F.col("_old.content_hash").eqNullSafe(F.col("_new.content_hash")), "update")
    )
    both = a.join(b, "path", "full_outer").withColumn("change_type", change)
    state = F.coalesce("_new", "_old")
    gone = F.col("change_type") == "delete"
    return both.where(F.col("change_type").isNotNull()).select(
        "path",
        *[
            (F.when(gone, TAG_DELETED).otherwise(state[c]) if c == "tag" else state[c]).alias(c)
            for c in columns
        ],
        F.when(gone, DELETE).otherwise(CREATE).alias("operation"),
        "change_type",
    )


def next_changes(old: DataFrame, new: DataFrame, last_seq: int, diff=diff_listings) -> DataFrame:
    """Diff as change-log rows numbered from ``last_seq + 1`` in path order.
    ``diff`` is how listings are compared, see also ``digests.diff_by_digests``."""
    return number_rows(_tombstones(diff(old, new)), "path", "_rn").withColumn(
        "seq", F.col("_rn") + F.lit(last_seq)
    ).drop("_rn")


def _tombstones(diff: DataFrame) -> DataFrame:
    """The log columns of a diff; a tombstone names the path only."""
    gone = F.col("tag") == TAG_DELETED
    rows = diff.drop("operation", "change_type")
    return rows.select(*[
        F.when(~gone, F.col(c)).alias(c)
        if c in ("id", "size", "content_hash", "server_modified") else F.col(c)
        for c in rows.columns
    ])


def resync_changes(listing: DataFrame, held: DataFrame, seq: int) -> DataFrame:
    """What turns a consumer that holds ``held(path, content_hash)`` into ``listing``.

    Only what differs is sent again, and what vanished while its position was
    invalid is deleted. All rows stand at ``seq``, the newest position of the
    listing, so the consumer goes on behind it; a path has one row.
    """
    old = held.select(*[
        F.col(field.name) if field.name in held.columns else F.lit(None).cast(field.dataType).alias(field.name)
        for field in listing.schema
    ])
    rows = _tombstones(diff_listings(old, listing)).withColumn("seq", F.lit(seq).cast("long"))
    if "name" in rows.columns:
        rows = rows.withColumn("name", F.coalesce("name", base_name(F.col("path"))))
    return rows


def resync_since(listing: DataFrame, last_processed_nanos: int) -> DataFrame:
    """Relisting after an expired cursor: skip what is older than the mark.

    A file modified exactly at the mark is sent again. The comparison is on
    the bare timestamp column so that it is pushed to the scan.
    """
    mark = F.timestamp_micros(F.lit(-(-last_processed_nanos // 1000)).cast("long"))
    return listing.where(F.col("server_modified") >= mark)


def compact_log(log: DataFrame) -> DataFrame:
    """The last change of each path, tombstones included, in the columns of the log.

    What a consumer whose position is anywhere in the log gets from the rows
    behind it, it also gets from their compaction: each path ends in the same
    state, and a delete of a folder keeps its place between the writes below it.
    """
    return latest_per_path(log).select(*log.columns)


def resume_decision(positions: DataFrame, log: DataFrame, floor: int | None = None) -> DataFrame:
    """Per saved position: resume, up_to_date, or for those whose successor is no
    longer kept compacted or resync.

    ``positions(consumer, saved)``; the retained range is one aggregate over
    the log, read as scalar subqueries. What was trimmed behind ``floor`` is
    kept in compacted form; None: nothing is.
    """
    first = log.agg(F.min("seq").alias("v")).scalar()
    last = log.agg(F.max("seq").alias("v")).scalar()
    trimmed = F.col("saved") + 1 < first
    status = F.when(trimmed & (F.col("saved") >= floor), "compacted").when(trimmed, "resync") \
        if floor is not None else F.when(trimmed, "resync")
    return positions.withColumn("status", status.when(F.col("saved") >= last, "up_to_date").otherwise("resume"))


def micro_batch(seq: Column, size: int, first: int = 1) -> Column:
    """Batch number of a log position when at most ``size`` go into a batch."""
    check_positive("size", size)
    return int_div(seq - F.lit(first), size)


def byte_unit(before: Column, size: Column, limit: int) -> Column:
    """Number of the unit an entry goes into when units are cut by payload bytes.

    ``before`` are the bytes of all entries before it. Entries that begin within
    the same ``limit`` bytes share a unit, which so holds less than twice that;
    an entry of ``limit`` bytes or more is a unit of its own. Numbers rise along
    the log and have gaps. Null sizes (deletes) count as 0.
    """
    check_positive("limit", limit)
    begin = int_div(F.coalesce(before, F.lit(0)), limit)
    return begin * 2 + F.when(F.coalesce(size, F.lit(0)) >= limit, 1).otherwise(0)


def byte_batches(log: DataFrame, limit: int) -> DataFrame:
    """``seq, size, batch`` of a log, admitted by bytes; the prefix sums run over blocks."""
    rows = running(log.select("seq", "size"), [], "seq", {"_before": ("sum", "size")}, inclusive=False)
    return rows.select("seq", "size", byte_unit(F.col("_before"), F.col("size"), limit).alias("batch"))


def last_processed(log: DataFrame, size: int, first: int = 1) -> DataFrame:
    """Per batch the newest modification time of its files, and the mark after it.

    The mark is a running maximum, so a late batch of old files cannot make a
    later resync repeat or skip work. Folders and tombstones do not count.
    """
    batches = (
        log.withColumn("batch", micro_batch(F.col("seq"), size, first))
        .groupBy("batch")
        .agg(F.max(F.when(is_file(F.col("tag")), F.col("server_modified"))).alias("newest"))
    )
    return running(batches, [], "batch", {"mark": ("max", "newest")}).select(
        "batch", "newest", "mark"
    )
