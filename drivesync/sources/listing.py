"""Folder listings: scope, pages and path checks over an entry table.

A listing is not recursive unless asked; entries in sub-folders are then left
out, as the store does it.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from drivesync.functions.numbers import int_div
from drivesync.functions.paths import explode_ancestors, is_top, is_under, parent_dir
from drivesync.operators.skew import lookup_join
from drivesync.options import check_page_size, check_positive, scope_path
from drivesync.schemas import TAG_FOLDER
from drivesync.session import shared_dir


def list_entries(entries: DataFrame, path: str = "", recursive: bool = False) -> DataFrame:
    """Entries of one folder. The prefix filter reaches the scan."""
    scope = scope_path(path)
    if recursive:
        return entries.where(is_under(F.col("path"), F.lit(scope)))
    return entries.where(
        F.startswith(F.col("path"), F.lit(scope + "/"))
        & (parent_dir(F.col("path")) == (scope or "/"))
    )


def list_folders(entries: DataFrame, folders: DataFrame, recursive: bool = False) -> DataFrame:
    """Entries of every folder in ``folders(folder)``, one pass for all of them.

    A recursive listing joins on each ancestor of an entry rather than on a
    prefix, so it stays an equi-join.
    """
    wanted = folders.select("folder").distinct()
    if recursive:
        placed = explode_ancestors(entries, "path", "folder")
    else:
        placed = entries.withColumn("folder", parent_dir(F.col("path")))
    return lookup_join(placed, wanted, ["folder"], ["path"], is_top(F.col("folder")), "left_semi")


def list_page(entries: DataFrame, limit: int, after: str | None = None) -> DataFrame:
    """The next page after path ``after``, in path order."""
    check_page_size(limit)
    rest = entries if after is None else entries.where(F.col("path") > after)
    return rest.orderBy("path").limit(limit)


def number_rows(rows: DataFrame, order: str, name: str = "rn") -> DataFrame:
    """Number all rows 1..n along ``order`` without one global window task.

    ``order`` should be (close to) unique. Range-partitioned rows are numbered
    inside their partition; the partition counts give the offsets. The sorted rows are
    checkpointed because both uses must see the same partition bounds.
    """
    shared_dir(rows.sparkSession)
    shift = 1 << 33
    placed = (
        rows.repartitionByRange(F.col(order))
        .sortWithinPartitions(order)
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_part", int_div(F.col("_mid"), shift))
    )
    # One row per partition of the sort, however many rows there are.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_mid") % shift + 1)
        .drop("_part", "_mid", "_offset")
    )


def paginate(entries: DataFrame, page_size: int) -> DataFrame:
    """All pages of a listing at once: ``page`` (0-based) and ``rn`` in path order."""
    check_positive("page_size", page_size)
    return number_rows(entries, "path").withColumn(
        "page", int_div(F.col("rn") - 1, page_size)
    )


def page_cursors(pages: DataFrame) -> DataFrame:
    """Per page its entry count, the cursor after it, and whether more follows."""
    per_page = pages.groupBy("page").agg(
        F.max("path").alias("cursor"), F.count(F.lit(1)).alias("entries")
    )
    last = pages.agg(F.max("page").alias("m")).scalar()
    return per_page.withColumn("has_more", F.col("page") < last)


def folders_of(entries: DataFrame) -> DataFrame:
    """Every folder that exists: named by a folder entry or holding a file."""
    named = entries.where(F.col("tag") == TAG_FOLDER).select(F.col("path").alias("folder"))
    holding = explode_ancestors(
        entries.select(parent_dir(F.col("path")).alias("p")).distinct()
        .select(F.concat("p", F.lit("/-")).alias("path")),
        "path",
        "folder",
    ).select("folder")
    return named.union(holding).distinct()


def verify_paths(requested: DataFrame, entries: DataFrame) -> DataFrame:
    """``requested(path)`` with ``status`` ok, not_found or not_a_folder.

    The empty path is the root and always there.
    """
    folders = folders_of(entries).select(
        F.col("folder").alias("path"), F.lit(True).alias("_folder")
    )
    files = (
        entries.where(F.coalesce("tag", F.lit("")) != TAG_FOLDER)
        .select("path").distinct().withColumn("_file", F.lit(True))
    )
    found = requested.select("path").distinct().join(folders, "path", "left").join(
        files, "path", "left"
    )
    return found.select(
        "path",
        F.when(F.col("path").isin("", "/") | F.col("_folder"), "ok")
        .when(F.col("_file"), "not_a_folder")
        .otherwise("not_found")
        .alias("status"),
    )


def require_folder(entries: DataFrame, path: str) -> None:
    """Fail before any work when the configured folder is missing or a file."""
    scope = scope_path(path)
    if not scope:
        return
    at = entries.where(F.col("path") == scope).select(F.col("tag") == TAG_FOLDER).take(1)
    if at and at[0][0]:
        return
    if entries.where(is_under(F.col("path"), F.lit(scope))).take(1):
        return
    reason = "not a folder" if at else "not found"
    raise ValueError(f"error verifying remote path {path!r}: {reason}")
