"""N-gram Jaccard join by a partitioned universe and the pigeonhole principle.

A document is the set of its n-gram hashes. Sets fall into size bands; the
universe of a band is cut into as many segments as elements can differ, plus
one. What a set holds in a segment is an index key, and in the first segments
of a band so is all but one of it (one-deletion neighbourhood). If a set probes
segments for equality (1) or for a difference of at most one element (2), and
these numbers add up to more than the elements that can differ, it meets every
partner in at least one of them. Which segments a set probes is decided by
cost: how many sets of the whole corpus share the key. Segments whose keys
nobody shares cost nothing, and enough of them prove that there is no partner.

Documents with equal sets are one class. What meets in a key is verified on the
full sets in rounds: a few probing sets (pivots) of every key against all its
members, ``PIVOTS`` times as many each round, but only where the two are not connected yet.
A group of near copies is connected after a round or two, so its pairs are never
written; no pair of different components stays unverified. A bit table of the
parities of a set's elements rules pairs out before, exactly: it differs in at
most as many bits as the sets differ in elements.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drivesync.llm.common import Words, blocks, byte_tables, mix, released, slices, stored
from drivesync.llm.graph import components
from drivesync.session import settings

WIDTH = 4
PERCENT = 85
# Words of 64 parities.
PARITIES = 8
PARITY = [f"p{i}" for i in range(PARITIES)]
# Pivots of a key in the first round, and how many times more in each further one.
PIVOTS = 8
# Comparisons with one pivot that a task gets; a pivot with more is sent to several.
TASK_PAIRS = 256
# Bits a marked document has in the bitmap of ids, and the most that bitmap has.
MARK_BITS = 32
MOST_BITS = 1 << 26
_LARGEST = 1 << 31
# Shuffle files go when the job that wrote them is done, not when the driver collects its garbage.
_CLEANUP = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def differing(size, percent: int):
    """Most elements a set can differ in from a partner that is not larger."""
    return 2 * size * (100 - percent) // (100 + percent)


def band_tops(percent: int) -> np.ndarray:
    """Largest set size of each band. Partners are in one band or in two that touch."""
    tops, low = [], 1
    while low < _LARGEST:
        tops.append(max(low, low * 10000 // percent**2) if percent < 100 else _LARGEST)
        low = tops[-1] + 1
    return np.array(tops)


def neighbour_segments(segments):
    """How many segments of a band have one-deletion keys."""
    return np.where(segments > 1, np.minimum(segments, 2 + segments // 32), 0)


def sets_of(texts: list, tables, width: int):
    """For blocks of texts: (index of the first, set sizes, their distinct hashes, ascending in each set)."""
    for begin, end in blocks(texts):
        hashes, doc, _ = Words(texts[begin:end], tables).shingles(width)
        order = np.lexsort((hashes, doc))
        hashes, doc = hashes[order], doc[order]
        fresh = np.ones(len(doc), bool)
        fresh[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
        yield begin, np.bincount(doc[fresh], minlength=end - begin), hashes[fresh]


def segment_keys(sizes, hashes, segments, owned: int):
    """(set, key, info) of sets cut into ``segments`` each; 0 segments give no key.

    ``info`` is the segment, whether the key leaves out one element, and ``owned``:
    whether these are the segments of the set's own band.
    """
    doc = np.repeat(np.arange(len(sizes)), sizes)
    inside = segments[doc] > 0
    doc, hashes = doc[inside], hashes[inside]
    base = np.cumsum(segments) - segments
    segment = ((hashes >> np.uint64(32)) * segments[doc].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    place = base[doc] + segment
    values = mix(hashes ^ np.uint64(0x5851F42D4C957F2D))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(values)])
    edges = np.searchsorted(place, np.arange(segments.sum() + 1))
    whole = sums[edges[1:]] - sums[edges[:-1]]
    owner = np.repeat(np.arange(len(sizes)), segments)
    number = np.arange(len(owner)) - base[owner]
    salt = mix((segments[owner].astype(np.uint64) << np.uint64(32)) + number.astype(np.uint64))
    less = np.flatnonzero(segment < neighbour_segments(segments)[doc])
    less_keys = mix((whole[place[less]] - values[less]) ^ salt[place[less]])
    return (np.concatenate([owner, doc[less]]), np.concatenate([mix(whole ^ salt), less_keys]),
            np.concatenate([number * 4 + owned, segment[less] * 4 + 2 + owned]))


def _packed(owner, values, count: int):
    """A binary array with the values of each owner (ascending)."""
    width = values.dtype.itemsize
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=count)) * width]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), count, [None, pa.py_buffer(offsets), pa.py_buffer(values.tobytes())])


def signatures(docs: DataFrame, percent: int, width: int) -> DataFrame:
    """``doc_id, row, text_key, n, k1, k2, need, segments, neighbours, p0.., keys, info`` of each
    row; equal sets have equal ``k1, k2``."""
    numbers = ["n", "k1", "k2", "need", "segments", "neighbours", *PARITY]
    schema = T.StructType([docs.schema["doc_id"], T.StructField("row", T.LongType()), T.StructField("text_key", T.LongType()), *(T.StructField(c, T.LongType()) for c in numbers),
                           T.StructField("keys", T.BinaryType()), T.StructField("info", T.BinaryType())])

    def run(batches):
        tables, tops = byte_tables(), band_tops(percent)
        band_segments = differing(tops, percent) + 1
        for batch in (part for whole in batches for part in slices(whole)):
            for begin, sizes, hashes in sets_of(batch.column("text").to_pylist(), tables, width):
                count = len(sizes)
                ends = np.cumsum(sizes)
                starts, full = ends - sizes, np.flatnonzero(sizes)
                columns = {"n": sizes}
                for name, factor in (("k1", 3), ("k2", 5)):
                    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes * np.uint64(factor) + np.uint64(factor)))])
                    columns[name] = (sums[ends] - sums[starts]).view(np.int64)
                bit = hashes & np.uint64(64 * PARITIES - 1)
                for i, name in enumerate(PARITY):
                    here = np.where(bit >> np.uint64(6) == np.uint64(i), np.uint64(1) << (bit & np.uint64(63)), np.uint64(0))
                    columns[name] = np.zeros(count, np.int64)
                    if len(full):
                        columns[name][full] = np.bitwise_xor.reduceat(here, starts[full]).view(np.int64)
                band = np.searchsorted(tops, sizes)
                own = np.where(sizes > 0, band_segments[band], 0)
                above = np.where((sizes * 100 // percent > tops[band]) & (sizes > 0), band_segments[band + 1], 0)
                above[above == own] = 0
                columns["need"] = differing(sizes, percent) + 1
                columns["segments"], columns["neighbours"] = own, neighbour_segments(own)
                found = [segment_keys(sizes, hashes, own, 1), segment_keys(sizes, hashes, above, 0)]
                owner, keys, info = (np.concatenate(c) for c in zip(*found))
                order = np.argsort(owner, kind="stable")
                owner = owner[order]
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).slice(begin, count) for c in ("doc_id", "row", "text_key")), *(pa.array(columns[c].astype(np.int64)) for c in numbers),
                    _packed(owner, keys[order].astype("<u8"), count), _packed(owner, info[order].astype("<u4"), count),
                ], names=schema.names)

    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(released(run), schema)


def _members(classes: DataFrame) -> DataFrame:
    """``key, node, info``: the index entries of all classes."""
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("node", T.LongType()), T.StructField("info", T.LongType())])

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole)):
            keys, info = batch.column("keys").to_pylist(), batch.column("info").to_pylist()
            counts = np.array([len(k) // 8 for k in keys], np.int64)
            node = np.repeat(batch.column("node").to_numpy(), counts)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.frombuffer(b"".join(keys), "<i8")), pa.array(node),
                pa.array(np.frombuffer(b"".join(info), "<u4").astype(np.int64))], names=schema.names)

    return classes.select("node", "keys", "info").mapInArrow(released(run), schema)


def allocate(shared: DataFrame, slim: DataFrame) -> DataFrame:
    """``key, node, probing`` of the shared index entries ``key, node, info, n``.

    A set has a first slot for every segment of its band, and a second one for
    those with neighbourhoods. It takes the ``need`` cheapest; slots whose keys
    nobody shares are free. A second slot is never cheaper than the first one.
    """
    owned = F.col("info").bitwiseAND(1) == 1
    rows = shared.withColumns({
        "segment": F.shiftright("info", 2), "less": F.col("info").bitwiseAND(2) == 2, "cost": F.col("n") - 1})
    cost = lambda kind: F.coalesce(F.sum(F.when(kind, F.col("cost"))), F.lit(0))
    costs = rows.where(owned).groupBy("node", "segment").agg(cost(~F.col("less")).alias("first"), cost(F.col("less")).alias("second"))
    slot = F.explode(F.array(
        F.struct(F.lit(1).alias("level"), F.col("first").alias("cost")),
        F.struct(F.lit(2).alias("level"), F.greatest("first", "second").alias("cost"))))
    per = Window.partitionBy("node")
    free = F.col("segments") + F.col("neighbours") - F.col("paid")
    paid = costs.select("node", "segment", slot.alias("slot")).join(slim.select("node", "need", "segments", "neighbours"), "node").where(
        (F.col("slot.cost") > 0) & ((F.col("slot.level") == 1) | (F.col("segment") < F.col("neighbours")))).withColumns({
            "paid": F.count("*").over(per), "place": F.row_number().over(per.orderBy("slot.cost", "slot.level", "segment"))})
    chosen = paid.where(F.col("place") <= F.col("need") - free).groupBy("node", "segment").agg(F.max("slot.level").alias("level"))
    joined = rows.join(chosen, ["node", "segment"], "left")
    probing = owned & (F.coalesce("level", F.lit(0)) >= F.when(F.col("less"), 2).otherwise(1))
    return joined.select("key", "node", probing.alias("probing"))


def _dealt(pairs: DataFrame) -> DataFrame:
    """``a, b, salt``: the pairs of a pivot ``b`` in as few parts as its task size allows,
    so that its set moves once where it meets few others."""
    parts = pairs.groupBy("b").agg(F.ceil(F.count("*") / TASK_PAIRS).alias("parts"))
    return pairs.join(parts, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("parts")).alias("salt"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` (``b`` a pivot) whose full sets are alike enough."""
    pairs = _dealt(pairs)
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("items").alias("one")), "a")
    right = pairs.select("b", "salt").distinct().join(sets.select(F.col("node").alias("b"), F.col("items").alias("two")), "b")
    both = left.join(right, ["b", "salt"]).select("a", "b", F.size("one").alias("x"), F.size("two").alias("y"),
                                                   F.size(F.array_intersect("one", "two")).alias("common"))
    return both.where(100 * F.col("common") >= percent * (F.col("x") + F.col("y") - F.col("common"))).select("a", "b")


def _marked(docs: DataFrame, nodes: DataFrame, count: int) -> DataFrame:
    """``doc, text`` of the rows of the ``count`` documents ``nodes``, and of few others: a bitmap of
    ids, of at most 8 MB, goes to the tasks, so that texts nobody asks for are not shuffled."""
    bits = min(MOST_BITS, max(1 << 15, 1 << (MARK_BITS * count).bit_length()))
    place = F.pmod(F.xxhash64("doc"), F.lit(bits))
    placed = lambda rows: rows.withColumns({
        "bucket": F.shiftright(place, 15), "bit": place.bitwiseAND((1 << 15) - 1)})
    marks = placed(nodes.select("doc")).groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("marks"))
    known = placed(docs.select(F.col("doc_id").cast("long").alias("doc"), "text"))
    set_ = F.expr("shiftright(cast(conv(hex(substring(marks, cast(bit div 8 + 1 as int), 1)), 16, 10) as int), cast(bit % 8 as int)) & 1 = 1")
    return known.join(F.broadcast(marks), "bucket").where(set_).select("doc", "text")


def _sets(docs: DataFrame, nodes: DataFrame, count: int, width: int) -> DataFrame:
    """``node, items``: the full sets of the ``count`` classes ``node, doc, text_key``."""
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("items", T.ArrayType(T.LongType()))])

    def run(batches):
        tables = byte_tables()
        for batch in (part for whole in batches for part in slices(whole)):
            for begin, sizes, hashes in sets_of(batch.column("text").to_pylist(), tables, width):
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                items = pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(begin, len(sizes)), items], names=schema.names)

    known = _marked(docs, nodes, count).select("doc", F.xxhash64("text").alias("text_key"), "text")
    return known.join(nodes, ["doc", "text_key"]).select("node", "text").mapInArrow(released(run), schema)


def _links(live: DataFrame, sets_of_nodes, percent: int) -> tuple[DataFrame, DataFrame]:
    """Verified links that connect all there are, of ``key, node, probing, n, p0..``, and the
    components ``node, root`` they make. ``sets_of_nodes`` gives the full sets ``node, items`` of
    a table ``node``; it is asked for those of pairs only, once each."""
    sketch = ["n", *PARITY]
    links = live.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    roots = live.select("node", F.col("node").alias("root")).limit(0)
    tried = sets = None
    pivots_a_key = PIVOTS
    while True:
        rooted = live.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        still = rooted.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.max("probing").alias("p")).where("x <> y and p")
        live = stored(rooted.join(still.select("key"), "key", "left_semi"), "live")
        if live.isEmpty():
            return links, roots
        rank = F.xxhash64("node", F.lit(pivots_a_key))
        pivots = live.where("probing").groupBy("key", F.pmod(rank, F.lit(pivots_a_key)).alias("slot")).agg(
            F.min_by(F.struct("node", "root", *sketch), rank).alias("pivot"))
        pivots = stored(pivots.select("key", "pivot"), "pivots")
        apart = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"pivot.{c}"))) for c in PARITY), F.lit(0))
        small, large = F.least("n", "pivot.n"), F.greatest("n", "pivot.n")
        most = F.expr(f"(n + pivot.n) * {100 - percent} div {100 + percent}")
        pairs = live.join(pivots, "key").where(
            (F.col("root") != F.col("pivot.root")) & (F.col("probing") | (F.col("n") <= F.col("pivot.n")))
            & (100 * small >= percent * large) & (apart <= most))
        pairs = pairs.select(F.col("node").alias("a"), F.col("pivot.node").alias("b")).groupBy(
            F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).agg(F.max("b").alias("b"))
        if tried is not None:
            pairs = pairs.join(tried, ["x", "y"], "left_anti")
        pairs = stored(pairs.select("x", "y", F.when(F.col("b") == F.col("x"), F.col("y")).otherwise(F.col("x")).alias("a"), "b"), "pairs")
        fresh = pairs.select("x", "y")
        tried = fresh if tried is None else tried.unionByName(fresh)
        if not pairs.isEmpty():
            ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
            more = sets_of_nodes(ends if sets is None else ends.join(sets.select("node"), "node", "left_anti"))
            sets = more if sets is None else sets.unionByName(more)
            found = stored(_verified(pairs, sets, percent), "found")
            if not found.isEmpty():
                links = links.unionByName(found)
                roots = components(links, "links")
        done = pivots.select("key", F.col("pivot.node").alias("node"))
        live = live.drop("root").join(done, ["key", "node"], "left_anti")
        pivots_a_key *= PIVOTS


def _placed(docs: DataFrame, percent: int, width: int) -> tuple[DataFrame, DataFrame]:
    """(``signatures`` of all rows, ``k1, k2, component_id`` of each class)."""
    seen = stored(signatures(docs.select("doc_id", "text"), percent, width), "signatures")
    linkable = seen.where("n > 0 and doc_id is not null")
    first = linkable.groupBy("k1", "k2").agg(F.min(F.struct(F.col("doc_id").cast("long").alias("doc"), "row")).alias("r"))
    classes = stored(first.select("k1", "k2", "r.doc", F.col("r.row").alias("node")), "classes")
    copies = linkable.select("k1", "k2", "row").join(classes, ["k1", "k2"]).where("row <> node").select("row")
    # Copies are left out, not first ones picked: keys need not move where copies are few.
    one = linkable.join(stored(copies, "copies"), "row", "left_anti").withColumnsRenamed({"row": "node"})
    members = _members(one)
    shared = stored(members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    shared = stored(members.join(shared, "key"), "entries")
    slim = one.select("node", F.col("doc_id").cast("long").alias("doc"), "text_key", "n", "need", "segments", "neighbours", *PARITY)
    entries = stored(allocate(shared, slim), "allocated")
    probed = entries.where("probing").select("key").distinct()
    live = stored(entries.join(probed, "key", "left_semi").join(slim.select("node", "n", *PARITY), "node"), "live")

    def sets_of_nodes(ends):
        nodes = stored(slim.join(ends, "node").select("node", "doc", "text_key"), "nodes")
        return stored(_sets(docs, nodes, nodes.count(), width), "sets")

    links, roots = _links(live, sets_of_nodes, percent)
    several = linkable.groupBy("doc_id").agg((F.min("k1") < F.max("k1")).alias("several")).where("several").select("doc_id")
    same = linkable.join(several, "doc_id").join(classes, ["k1", "k2"]).select("doc_id", "node")
    same = same.groupBy("doc_id").agg(F.min("node").alias("a")).join(same, "doc_id").select("a", F.col("node").alias("b"))
    if not same.isEmpty():
        roots = components(links.unionByName(same), "links")
    placed = classes.join(roots, "node", "left").select("k1", "k2", "doc", F.coalesce("root", "node").alias("root"))
    least = placed.groupBy("root").agg(F.min("doc").alias("component_id"))
    return seen, stored(placed.join(least, "root").select("k1", "k2", "component_id"), "components")


def jaccard_join(docs: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``doc_id, text``.

    Documents link where 100 * intersection >= ``percent`` * union of their sets of
    ``width`` words; fewer words are one n-gram. ``component_id`` is the least
    ``doc_id`` reachable by links. Null text and text without words have no n-gram
    and link with nothing. Rows with one ``doc_id`` are one document: each row has
    its own ``n_shingles``, and what links with one of them is linked with all.
    Rows with a null ``doc_id`` link with nothing and have no ``component_id``.
    Other columns are ignored; an empty table gives no rows. N-grams are compared
    by 64-bit hashes.
    """
    if not 1 <= percent <= 100:
        raise ValueError(f"percent must be from 1 to 100, not {percent}")
    with settings(docs.sparkSession, _CLEANUP):
        seen, by_class = _placed(docs, percent, width)
    joined = seen.alias("s").join(by_class.alias("c"), (F.col("s.k1") == F.col("c.k1")) & (F.col("s.k2") == F.col("c.k2"))
                                  & F.col("doc_id").isNotNull() & (F.col("n") > 0), "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", F.col("doc_id").cast("long")).alias("component_id"))

