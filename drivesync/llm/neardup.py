"""Near duplicates by SetSketch registers.

A document is the set of its five-word shingles. Its sketch holds, for each of
``REGISTERS`` hash functions, the least exponential value over the set, kept as
the exponent of a base near one and truncated; sketches of parts merge by the
larger register. Equal runs of registers (bands) make two sets candidates, the
joint likelihood of larger, smaller and equal registers estimates their
likeness, and what isn't ruled out is confirmed on the full sets.

Documents with equal sets are one class, so copies cost no pairs. Candidates
are stars to the least member of a band bucket; what they connect is a family.
Within a family all links are found: a task takes a block of members, or two,
and gives the edges of a spanning forest, so no pair is written but those that
connect. Families of any size are cut into blocks of bounded size.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drivesync.llm.common import WIDTH, Words, blocks, byte_tables, mix, odd_numbers, released, slices, stored
from drivesync.llm.graph import components

REGISTERS = 252
BASE = 1.001
RATE = 20.0
# Greatest chance that a pair at the limit shares no band.
MISSED = 3e-6
# Shingles and members of one block of a family.
BLOCK_SHINGLES = 500_000
BLOCK_MEMBERS = 1024
# Standard deviations of the estimate below which a candidate is ruled out.
DEVIATIONS = 5.0
LOW48 = (1 << 48) - 1


def shingle_sets(texts: list, tables, width: int = WIDTH):
    """For blocks of texts: (index of the first text, set sizes, sorted distinct 48-bit shingles of all)."""
    for begin, end in blocks(texts):
        words = Words(texts[begin:end], tables)
        hashes, doc, _ = words.shingles(width)
        # Texts of a block are few, so index and 48 bits fit one sortable number.
        for low in range(0, end - begin, 1 << 15):
            part = (doc >= low) & (doc < low + (1 << 15))
            keys = np.unique(((doc[part] - low).astype(np.uint64) << np.uint64(48)) | (hashes[part] >> np.uint64(16)))
            sizes = np.bincount((keys >> np.uint64(48)).astype(np.int64), minlength=min(1 << 15, end - begin - low))
            yield begin + low, sizes, keys & np.uint64(LOW48)


def sketch(sizes: np.ndarray, shingles: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """Registers (unsigned 16 bit) of each set; of an empty one all 0."""
    out = np.zeros((len(sizes), registers), dtype="<u2")
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    begin = np.concatenate([[0], np.cumsum(sizes)])[full]
    short = mix(shingles).astype(np.uint32)
    numbers = odd_numbers(2 * registers, 3).astype(np.uint32)
    least = np.empty((registers, len(full)), dtype=np.uint32)
    work = np.empty_like(short)
    for k in range(registers):
        np.bitwise_xor(short, numbers[2 * k], out=work)
        np.multiply(work, numbers[2 * k + 1], out=work)
        least[k] = np.minimum.reduceat(work, begin)
    value = -np.log1p(-(least.T + 0.5) / 2.0**32) / RATE
    out[full] = np.clip(np.floor(1 - np.log(value) / np.log(BASE)), 0, 65535)
    return out


def likeness(one: np.ndarray, others: np.ndarray, size: int, sizes: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of a sketch to others, given the set sizes."""
    m = others.shape[1]
    larger, equal = (one > others).sum(1), (one == others).sum(1)
    smaller = m - larger - equal
    u = (size / (size + sizes))[:, None]
    v = 1 - u
    most = np.minimum(u / v, v / u)
    j = np.linspace(0, 1, 101)[None, :] * most
    p = lambda x: np.clip(-np.log(np.clip(1 - x * (BASE - 1) / BASE, 1e-12, 1)) / np.log(BASE), 1e-9, 1 - 1e-9)
    up, down = p(u - v * j), p(v - u * j)
    total = larger[:, None] * np.log(up) + smaller[:, None] * np.log(down) + equal[:, None] * np.log(np.clip(1 - up - down, 1e-9, 1))
    return j[np.arange(len(j)), total.argmax(1)]


def sketches(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, text_key, n_shingles, k1, k2, registers``; equal sets have equal ``k1, k2``."""
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("text_key", T.LongType()), T.StructField("n_shingles", T.LongType()),
        T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()), T.StructField("registers", T.BinaryType())])

    def run(batches):
        tables = byte_tables()
        for batch in (part for whole in batches for part in slices(whole)):
            texts = batch.column("text").to_pylist()
            sizes, keys, regs = [], ([], []), []
            for _, size, shingles in shingle_sets(texts, tables, width):
                begin = np.concatenate([[0], np.cumsum(size)])
                for key, salt in zip(keys, (1, 2)):
                    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(shingles * np.uint64(2 * salt + 1) + np.uint64(salt)))])
                    key += (sums[begin[1:]] - sums[begin[:-1]]).view(np.int64).tolist()
                sizes += size.tolist()
                regs += [r.tobytes() for r in sketch(size, shingles)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()), pa.array(keys[0], pa.int64()),
                pa.array(keys[1], pa.int64()), pa.array(regs, pa.binary())], names=schema.names)

    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(released(run), schema)


def band_rows(percent: int) -> int:
    """Most registers a band for which a pair at the limit is missed no more often
    than ``MISSED``: 7 for 85 percent, 6 for 80. Below 5 percent there are none."""
    alike = percent / 100
    fit = [r for r in range(1, REGISTERS + 1) if 0 < alike <= 1 and (1 - alike**r) ** (REGISTERS // r) <= MISSED]
    if not fit:
        raise ValueError(f"percent must be from 5 to 100, not {percent}")
    return max(fit)


def _families(classes: DataFrame, rows: int) -> DataFrame:
    """``node, root``: what the stars of the band buckets connect."""
    bands = F.expr(
        f"transform(sequence(0, {REGISTERS // rows - 1}), x -> xxhash64(substring(registers, 1 + {2 * rows} * x, {2 * rows}), x))")
    members = classes.select("node", F.explode(bands).alias("band"))
    buckets = members.groupBy("band").agg(F.min("node").alias("leader"), F.count("*").alias("n")).where("n > 1")
    stars = members.join(buckets, "band").where("node <> leader").select(
        F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    return components(stars, "families")


class Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, x: int, y: int) -> None:
        self.up[self.root(y)] = self.root(x)


def link_group(nodes: list, part: list, texts: list, registers: list, percent: int, tables, width: int):
    """Edges of a spanning forest of all links in a block, or between two blocks."""
    n = len(nodes)
    sets, sizes = [], []
    for _, size, shingles in shingle_sets(texts, tables, width):
        sets += [frozenset(s.tolist()) for s in np.split(shingles, np.cumsum(size)[:-1])]
        sizes += size.tolist()
    sizes = np.array(sizes)
    regs = np.frombuffer(b"".join(registers), dtype="<u2").reshape(n, -1)
    least = percent / 100 - DEVIATIONS * (percent / 100 * (1 - percent / 100) / regs.shape[1]) ** 0.5
    forest, part = Forest(n), np.array(part)
    cross = len(set(part.tolist())) > 1
    for x in range(n - 1):
        rest = np.arange(x + 1, n)
        fit = (np.minimum(sizes[rest], sizes[x]) * 100 >= percent * np.maximum(sizes[rest], sizes[x]))
        if cross:
            fit &= part[rest] != part[x]
        rest = rest[fit]
        if n > 2 and len(rest):
            guess = likeness(regs[x], regs[rest], sizes[x], sizes[rest])
            order = np.argsort(-guess, kind="stable")
            rest = rest[order[guess[order] >= least]]
        for y in rest.tolist():
            if forest.root(x) != forest.root(y):
                common = len(sets[x] & sets[y])
                if 100 * common >= percent * (len(sets[x]) + len(sets[y]) - common):
                    forest.join(x, y)
                    yield nodes[x], nodes[y]


def _links(members: DataFrame, percent: int, width: int) -> DataFrame:
    """Verified edges ``a, b``; members: ``family, i, j, part, node, text, registers``."""
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def run(batches):
        tables = byte_tables()
        key, held = None, ([], [], [], [])

        def linked():
            if len(held[0]) > 1:
                pairs = list(link_group(*held, percent, tables, width))
                if pairs:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pairs)], names=schema.names)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("family", "i", "j", "node", "part", "text", "registers")]
            for family, i, j, *row in zip(*columns):
                if key != (family, i, j):
                    yield from linked()
                    key, held = (family, i, j), ([], [], [], [])
                for column, value in zip(held, row):
                    column.append(value)
        yield from linked()

    groups = ["family", "i", "j"]
    return members.repartition(*groups).sortWithinPartitions(*groups, "node").mapInArrow(released(run), schema)


def near_duplicates(docs: DataFrame, percent: int = 80, width: int = WIDTH) -> DataFrame:
    """``doc_id, text_key, n_shingles, component_id, kept`` of every row.

    Documents are linked where 100 * intersection >= ``percent`` * union of
    their shingle sets; ``component_id`` is the least ``doc_id`` a document is
    connected with. Fewer words than ``width`` are one shingle. Null text and
    text without words have no shingle and no link. Rows with a null ``doc_id``
    stand alone: no ``component_id``, kept. Rows with one ``doc_id`` are judged
    by their texts, each as a row. Other columns are ignored.
    """
    rows = band_rows(percent)
    base = docs.select("doc_id", "text")
    seen = stored(sketches(base, width), "sketches")
    linkable = seen.where("n_shingles > 0 and doc_id is not null")
    classes = stored(linkable.groupBy("k1", "k2").agg(
        F.min("doc_id").cast("long").alias("node"), F.min_by(F.struct("text_key", "registers", "n_shingles"), "doc_id").alias("r"),
    ).select("k1", "k2", "node", "r.*"), "classes")
    families = _families(classes, rows)
    member = classes.join(families, "node").select("node", "text_key", "registers", "n_shingles", F.col("root").alias("family"))
    counted = member.groupBy("family").agg(F.greatest(
        F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES), F.ceil(F.count("*") / BLOCK_MEMBERS)).cast("int").alias("n"))
    member = stored(member.join(counted, "family").withColumn(
        "part", F.pmod(F.xxhash64("node", F.lit(5)), F.col("n")).cast("int")), "members")
    texts = base.select(F.col("doc_id").cast("long").alias("node"), F.xxhash64("text").alias("text_key"), "text")
    blocks_of = member.join(texts, ["node", "text_key"]).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).select(
        "family", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "node", "part", "text", "registers")
    found = components(_links(blocks_of, percent, width), "links")
    placed = classes.join(found, "node", "left").select("k1", "k2", "node", F.coalesce("root", "node").alias("root"))
    least = placed.groupBy("root").agg(F.min("node").alias("component_id"))
    by_class = stored(placed.join(least, "root").select("k1", "k2", "component_id"), "components")
    joined = seen.alias("s").join(by_class.alias("c"), (F.col("s.k1") == F.col("c.k1")) & (F.col("s.k2") == F.col("c.k2")) & (F.col("n_shingles") > 0), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", F.col("doc_id").cast("long")))
    return joined.select("doc_id", "text_key", "n_shingles", component.alias("component_id"),
                         F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group: the one with the least ``doc_id``,
    and of rows equal in id and text one. Columns stay as they are. Rows with a
    null id, with null text or without words are in no group and stay; of the
    latter two, rows with one id are one. An empty table stays empty."""
    found = near_duplicates(docs, percent).where("kept").groupBy("doc_id", "text_key").agg(F.count("*").alias("n"))
    found = stored(found, "kept").alias("k")
    key = F.xxhash64(F.col("d.text"))
    joined = docs.alias("d").join(found, F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (key == F.col("k.text_key")))
    plain = joined.where("k.n = 1 or k.doc_id is null").select("d.*")
    # Longer than any name in docs.
    name = "_" * (1 + max(map(len, docs.columns)))
    repeated = joined.where("k.n > 1 and k.doc_id is not null").select("d.*", key.alias(name))
    return plain.unionByName(repeated.dropDuplicates(["doc_id", name]).drop(name))
