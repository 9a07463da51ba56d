"""Final file state from ordered writes and deletes.

Deleting a path that is not there is not an error unless
``missing_deletes`` is consulted; deleting a folder takes its whole subtree.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drivesync.functions.paths import explode_ancestors, is_top
from drivesync.operators.skew import lookup_join, running


def latest_per_path(events: DataFrame, path: str = "path", seq: str = "seq") -> DataFrame:
    """Last event of each path; ``seq`` is unique.

    An aggregate, not a window: map-side combining leaves one row per path and
    task, so a path with most of the events costs no more than others.
    """
    rest = [c for c in events.columns if c not in (path, seq)]
    return events.groupBy(path).agg(
        F.max(seq).alias(seq), *[F.max_by(c, seq).alias(c) for c in rest]
    )


def drop_deleted_subtrees(
    files: DataFrame, deletes: DataFrame, path: str = "path", seq: str = "seq"
) -> DataFrame:
    """Files without those a later delete of some ancestor folder took along.

    The file rows (no payload) go along through the ancestor join, so that
    what produced them is evaluated once.
    """
    newest = deletes.groupBy(F.col(path).alias("ancestor")).agg(F.max(seq).alias("_gone"))
    placed = explode_ancestors(files, path, "ancestor", root=True)
    joined = lookup_join(placed, newest, ["ancestor"], [path], is_top(F.col("ancestor")))
    # One row per file again. Grouping would turn -0.0 into 0.0, hence first().
    floats = [name for name, kind in files.dtypes if kind in ("float", "double")]
    keys = [name for name in files.columns if name not in floats]
    return (
        joined.groupBy(*keys)
        .agg(F.max("_gone").alias("_gone"), *[F.first(name).alias(name) for name in floats])
        .where(F.col("_gone").isNull() | (F.col("_gone") <= F.col(seq)))
        .select(*files.columns)
    )


def apply_latest(
    events: DataFrame, deleted: str = "deleted", path: str = "path", seq: str = "seq"
) -> DataFrame:
    """Live files after all events; ``deleted`` flags the deletes."""
    live = latest_per_path(events, path, seq).where(~F.col(deleted)).drop(deleted)
    deletes = events.where(F.col(deleted)).select(path, seq)
    return drop_deleted_subtrees(live, deletes, path, seq)


def delete_prefixes(files: DataFrame, folders: DataFrame, path: str = "path") -> DataFrame:
    """Files outside every folder of ``folders(folder)``, and not named by one."""
    gone = folders.select(F.col("folder").alias("ancestor")).distinct()
    placed = explode_ancestors(files.select(path), path, "ancestor").union(
        files.select(path, F.col(path).alias("ancestor"))
    )
    taken = lookup_join(placed, gone, ["ancestor"], [path], is_top(F.col("ancestor")), "left_semi")
    return files.join(taken.select(path).distinct(), path, "left_anti")


def missing_deletes(events: DataFrame, deleted: str = "deleted") -> DataFrame:
    """Deletes of a path that held nothing at that point (errors in strict mode).

    Every event is placed at its path and at the ancestors of it (bounded by
    depth). A path exists when the newest write at or below it is later than
    the newest delete of it or of an ancestor.
    """
    events = events.select("path", "seq", deleted)
    placed = events.withColumn("node", F.col("path")).union(
        explode_ancestors(events, "path", "node")
    )
    marked = placed.withColumns({
        "_w": F.when(~F.col(deleted), F.col("seq")),
        "_d": F.when(F.col(deleted) & (F.col("node") == F.col("path")), F.col("seq")),
    })
    seen = running(
        marked, ["node"], "seq", {"last_write": ("max", "_w"), "last_delete": ("max", "_d")},
        inclusive=False,
    ).where(F.col(deleted))
    state = seen.groupBy("path", "seq").agg(
        F.max(F.when(F.col("node") == F.col("path"), F.col("last_write"))).alias("w"),
        F.max("last_delete").alias("d"),
    )
    held = F.col("w").isNotNull() & (F.col("d").isNull() | (F.col("d") < F.col("w")))
    return state.where(~held).select("path", "seq")
