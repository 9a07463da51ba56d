"""Path expressions, all native columns.

A ``..`` that would leave the base folder is reported by ``escapes_base``
rather than followed.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def parent_dir(path: Column) -> Column:
    """Folder holding ``path``: '/' for a root-level entry, '.' without any slash."""
    head = F.regexp_replace(path, "/[^/]*$", "")
    return (
        F.when(~F.contains(path, F.lit("/")), F.lit("."))
        .when(head == "", F.lit("/"))
        .otherwise(head)
    )


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def clean_path(path: Column) -> Column:
    """Rooted form of ``path`` without empty, '.' and '..' segments.

    Paths that are clean already (the usual case) skip the segment walk.
    """
    rooted = F.concat(F.lit("/"), path)

    def step(stack: Column, part: Column) -> Column:
        return (
            F.when(part.isin("", "."), stack)
            .when(part == "..", F.slice(stack, F.lit(1), F.greatest(F.size(stack) - 1, F.lit(0))))
            .otherwise(F.array_append(stack, part))
        )

    walked = F.aggregate(
        F.split(rooted, "/"),
        F.array().cast("array<string>"),
        step,
        lambda stack: F.concat(F.lit("/"), F.array_join(stack, "/")),
    )
    is_clean = path.startswith("/") & ~path.rlike(r"//|/\.{1,2}(/|$)|.+/$")
    return F.when(is_clean, path).otherwise(walked)


def is_under(path: Column, folder: Column) -> Column:
    """True when ``path`` lies anywhere below ``folder`` ('' or '/' is the root)."""
    stem = F.regexp_replace(folder, "/$", "")
    return F.startswith(path, F.concat(stem, F.lit("/")))


def is_top(path: Column) -> Column:
    """True for the root and the folders in it, which have most entries below them."""
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit(""))) <= 1


def target_path(base: Column, collection: Column, name: Column) -> Column:
    """Where a record lands: base, then collection (default root), then name."""
    return clean_path(F.concat(base, F.lit("//"), F.coalesce(collection, F.lit("")), F.lit("/"), name))


def escapes_base(path: Column, base: Column) -> Column:
    """True when a cleaned target is neither the cleaned base nor below it."""
    return outside(path, clean_path(base))


def outside(path: Column, root: Column) -> Column:
    """True when a cleaned path is neither the cleaned folder nor below it."""
    return ~((path == root) | is_under(path, root))


def clean_literal(path: str) -> str:
    """``clean_path`` of a string."""
    stack: list[str] = []
    for part in path.split("/"):
        if part == "..":
            del stack[-1:]
        elif part not in ("", "."):
            stack.append(part)
    return "/" + "/".join(stack)


def explode_ancestors(df, path: str = "path", alias: str = "ancestor", root: bool = False):
    """One row per proper ancestor folder of ``path``; the root (as '') only on request.

    The rows per path are bounded by its depth, so an equi-join on ``alias``
    replaces a prefix (range) join.
    """
    depth = F.size(F.split(F.col(path), "/")) - 1
    levels = F.sequence(F.lit(1 if root else 2), depth)
    return (
        df.where(depth >= (1 if root else 2))
        .withColumn("_level", F.explode(levels))
        .withColumn(alias, F.call_function("substring_index", F.col(path), F.lit("/"), F.col("_level")))
        .drop("_level")
    )
