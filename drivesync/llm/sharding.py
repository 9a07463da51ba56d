"""Sharding by vector bin packing over bytes, tokens and rows.

Rows with equal text are a group. Groups are gathered into cells: a group that
would be a visible share of a shard is cut into cells of its own, all others
fall by hash into cells of falling size, half of them into the first level, a
quarter into the next. The number of cells is bounded whatever the input, so
the packing of cells works on a small table: in falling size, each goes to the
shard whose residual capacity has the highest dot product with its size.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drivesync.llm.common import stored

SHARDS = 40
ROW_BYTES = 16
LEVELS = 10
LEVEL_CELLS = 512
# A group beyond this share of a shard, in rows or bytes, is cut into cells of that size.
LARGE_SHARE = 1 / 64
LAW = "bytes"
# Bytes, tokens, rows: the law is about bytes, the others break near ties.
WEIGHTS = (64, 1, 1)


def place_cells(cells: list[tuple], shards: int) -> list[int]:
    """Shard of each (bytes, tokens, rows), by the largest dot product of its
    size with what is left of the shard's capacity, all as weighted shares of the whole."""
    totals = [sum(c[i] or 0 for c in cells) or 1 for i in range(3)]
    sizes = [[(c[i] or 0) / totals[i] * WEIGHTS[i] ** 0.5 for i in range(3)] for c in cells]
    left = [[w**0.5 / shards for w in WEIGHTS] for _ in range(shards)]
    chosen = [0] * len(cells)
    for at in sorted(range(len(cells)), key=lambda k: (-sum(a * w**0.5 for a, w in zip(sizes[k], WEIGHTS)), k)):
        size = sizes[at]
        best = max(range(shards), key=lambda s: (sum(a * b for a, b in zip(size, left[s])), -s))
        chosen[at] = best
        left[best] = [a - b for a, b in zip(left[best], size)]
    return chosen


def _seen(docs: DataFrame) -> DataFrame:
    """One slim row per document; the text is read once and left behind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long").alias("tokens"),
        F.unhex(F.md5(text)).alias("text_key"),
    )


def assign(docs: DataFrame, shards: int = SHARDS, large_share: float = LARGE_SHARE) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row.

    The law is ``bytes``: shards have near equal sizes. A group of equal texts
    stays in one shard unless it is more than ``large_share`` of a shard.
    Null text is a group with the empty text; rows with the same or a null
    ``doc_id`` are rows as any other, rows equal in all stay together; other
    columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    seen = stored(_seen(docs), "shard-rows")
    groups = seen.groupBy("text_key").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    total = seen.agg(F.sum("size"), F.count("*")).first()
    most_bytes = max(1.0, (total[0] or 0) / shards * large_share)
    most_rows = max(1.0, total[1] / shards * large_share)
    # At most 2 * shards / large_share rows: each is that share of all bytes or rows.
    large = groups.where((F.col("rows") > 1) & ((F.col("bytes") > most_bytes) | (F.col("rows") > most_rows))).select(
        "text_key", F.ceil(F.greatest(F.col("bytes") / most_bytes, F.col("rows") / most_rows)).alias("parts"))
    spread = F.xxhash64("text_key")
    level = F.least(F.lit(LEVELS), F.lit(64) - F.length(F.ltrim(F.lit("0"), F.lpad(F.bin(spread), 64, "0"))))
    cell = F.when(F.col("parts").isNull(), F.concat_ws(
        ":", level, F.pmod(F.xxhash64(F.col("text_key"), F.lit(1)), F.lit(LEVEL_CELLS)))
    ).otherwise(F.concat_ws(":", F.hex("text_key"), F.pmod(F.xxhash64("doc_id"), F.col("parts"))))
    rows = stored(seen.join(F.broadcast(large), "text_key", "left").withColumn("cell", cell)
                  .select("doc_id", "size", "text_crc32", "tokens", "cell"), "shard-cells")
    cells = rows.groupBy("cell").agg(F.sum("size"), F.sum("tokens"), F.count("*")).orderBy("cell").collect()
    shard_of = place_cells([tuple(c)[1:] for c in cells], shards)
    filled, placed = [0] * shards, []
    for c, shard in zip(cells, shard_of):
        placed.append((c[0], shard, filled[shard]))
        filled[shard] += c[3]
    table = spark.createDataFrame(placed, T.StructType([
        T.StructField("cell", T.StringType()), T.StructField("shard", T.IntegerType()), T.StructField("first", T.LongType())]))
    within = Window.partitionBy("cell").orderBy("doc_id", "text_crc32")
    return rows.withColumn("at", F.row_number().over(within)).join(F.broadcast(table), "cell").select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        (F.col("first") + F.col("at") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
