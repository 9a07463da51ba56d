"""Joins and running aggregates that hold when one key owns much of the data."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from drivesync.functions.numbers import int_div

MAX_SALTS = 64
# Rows of a lookup that may be broadcast; keys are paths, of a few KiB at most.
FEW_ROWS = 10_000
# Rows of one group in one window task: order values per block.
BLOCK_WIDTH = 65_536


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: list[str],
    spread: list[str],
    hot: Column,
    how: str = "left",
    salts: int | None = None,
) -> DataFrame:
    """Join ``rows`` to a ``lookup`` that has one row per key, some of them hot.

    ``hot`` is a condition on the key columns. The rows of a hot key go to
    ``salts`` partitions by a hash of ``spread`` (stable under task retry), and
    only the lookup rows of hot keys are copied to each. What is still too
    large in one partition is split by the adaptive skew join, on which joins
    without keys known to be hot rely alone. Spark broadcasts the lookup by
    itself where its measured size allows.
    """
    if salts is None:
        partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salts = max(1, min(MAX_SALTS, partitions))
    cold, last = F.lit(0), F.lit(salts - 1)
    place = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    salted = rows.withColumn("_salt", F.when(hot, place).otherwise(cold))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(cold, F.when(hot, last).otherwise(cold))))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def are_few(rows: DataFrame) -> bool:
    """Whether ``rows`` may be broadcast. Counts them, so they should be stored."""
    return rows.limit(FEW_ROWS + 1).count() <= FEW_ROWS


def running(
    rows: DataFrame,
    group: list[str],
    order: str,
    outputs: dict[str, tuple[str, str]],
    inclusive: bool = True,
    width: int = BLOCK_WIDTH,
) -> DataFrame:
    """Add running aggregates along the integer column ``order``.

    ``outputs`` maps a new column to ('sum' | 'max', input column). With
    ``inclusive`` false a row sees only the rows before it. Each group is cut
    into blocks of ``width`` order values: blocks are aggregated first, the
    windows then run over blocks, and over the rows inside one block. No task
    takes a whole group, whatever its size.
    """
    combine = {"sum": F.sum, "max": F.max}
    keys = [*group, "_block"]
    blocked = rows.withColumn("_block", int_div(F.col(order), width))

    totals = blocked.groupBy(*keys).agg(
        *[combine[kind](value).alias(f"_{name}_block") for name, (kind, value) in outputs.items()]
    )
    before = Window.partitionBy(*group).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bases = totals.select(
        *keys,
        *[combine[kind](f"_{name}_block").over(before).alias(f"_{name}_base")
          for name, (kind, _) in outputs.items()],
    )

    last = Window.currentRow if inclusive else -1
    inside = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, last)

    def merged(name: str, kind: str, value: str) -> Column:
        base, local = F.col(f"_{name}_base"), F.col(f"_{name}_local")
        if kind == "max":
            return F.greatest(base, local)
        return F.coalesce(base, F.lit(0)) + F.coalesce(local, F.lit(0))

    local = blocked.select(
        "*",
        *[combine[kind](value).over(inside).alias(f"_{name}_local")
          for name, (kind, value) in outputs.items()],
    )
    joined = local.join(bases, keys, "left")
    return joined.select(
        *[F.col(c) for c in rows.columns if c not in outputs],
        *[merged(name, kind, value).alias(name) for name, (kind, value) in outputs.items()],
    )
