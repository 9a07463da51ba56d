"""Order-free digests of folders, so that equal subtrees of two listings are
left out before their files are compared.

The digest of an entry is two 64-bit hashes of its path and content hash, that
of a folder the exclusive or over its entries with their number. Digests of
parts combine into that of the whole, so they are plain combining aggregates:
entries meet in their folder only, and folders, not entries, in the folders
above them. Two folders that differ have equal digests with a chance of about
2^-128; the hashes are no defence against content made to collide.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drivesync.functions.paths import explode_ancestors, parent_dir
from drivesync.operators.changes import diff_listings

DIGEST = ["files", "high", "low"]


def _combined() -> list:
    return [F.sum("files").alias("files"), F.bit_xor("high").alias("high"), F.bit_xor("low").alias("low")]


def folder_digests(listing: DataFrame) -> DataFrame:
    """``folder, files, high, low`` of what lies directly in each folder that holds an entry.

    ``listing`` has one row per path. A null content hash differs from an empty one.
    """
    content = [F.col("path"), F.col("content_hash").isNull(), F.coalesce("content_hash", F.lit(""))]
    entries = listing.select(
        parent_dir(F.col("path")).alias("folder"), F.lit(1).cast("long").alias("files"),
        F.xxhash64(F.lit(1), *content).alias("high"), F.xxhash64(F.lit(2), *content).alias("low"))
    return entries.groupBy("folder").agg(*_combined())


def subtree_digests(folders: DataFrame) -> DataFrame:
    """``folder, files, high, low`` of everything below each folder, from ``folder_digests``.

    The root is '/'. Folders that hold folders only have a row, too.
    """
    # A folder stands for its own subtree and for those of the folders above it.
    inside = F.concat(F.when(F.col("folder") == "/", "").otherwise(F.col("folder")), F.lit("/"))
    above = explode_ancestors(folders.withColumn("_inside", inside), "_inside", "_above", root=True)
    placed = above.select(F.when(F.col("_above") == "", "/").otherwise(F.col("_above")).alias("folder"), *DIGEST)
    return placed.groupBy("folder").agg(*_combined())


def unequal_folders(old: DataFrame, new: DataFrame) -> DataFrame:
    """``folder, old_files, new_files`` where two tables of digests differ; 0 files: no such folder."""
    a = old.select("folder", F.struct(*DIGEST).alias("_old"))
    b = new.select("folder", F.struct(*DIGEST).alias("_new"))
    both = a.join(b, "folder", "full_outer").where(~F.col("_old").eqNullSafe(F.col("_new")))
    return both.select("folder", *[
        F.coalesce(F.col(f"_{side}.files"), F.lit(0).cast("long")).alias(f"{side}_files") for side in ("old", "new")])


def diff_by_digests(old: DataFrame, new: DataFrame) -> DataFrame:
    """The rows of ``diff_listings``, comparing entries of unequal folders only.

    Both listings are read twice, so they should be stored: once for the digests
    (path and content hash), once for the entries of folders that differ. What
    is shuffled for the comparison follows the changes, not the listing. The
    folder table is broadcast where Spark finds it small; else a folder with many
    entries is split by the adaptive skew join.
    """
    folders = unequal_folders(folder_digests(old), folder_digests(new)).select(F.col("folder").alias("_folder"))

    def touched(listing: DataFrame) -> DataFrame:
        return listing.join(folders, parent_dir(F.col("path")) == F.col("_folder"), "left_semi")

    return diff_listings(touched(old), touched(new))
