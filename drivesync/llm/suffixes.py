"""Removal of long repeated byte strings, by sorted anchor suffixes.

A byte goes if a string of ``length`` bytes that covers it also starts in a
document with a smaller id. Suffixes are sorted only where a window of that
length has its least hash of ``GRAM`` bytes (its anchor): equal windows have
equal anchors, so about one suffix in fourteen stands for all, and what holds
at an anchor induces the windows around it:

1. anchors whose hash is in one document only are dropped;
2. of the others, the run of windows an anchor owns is compared as one string;
   a run that a smaller document has too goes as a whole;
3. where one anchor has different runs (at the ends of a passage, around an
   edit), the windows of the first document with each run are compared singly.

Texts are stored once, in units of some megabytes. Each step sends sorted keys
of a unit, with the least document of each, in cells by hash to the tasks that
compare them, and gets one answer a key back. A unit sends a key once however
often it holds it, so a passage in a third of all documents costs a key a unit.
"""

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drivesync.llm.common import _powers, mix, released, slices, stored

LENGTH = 50
GRAM = 24
UNIT_BYTES = 4 << 20
CELL_BYTES = 16 << 20
CHUNK = 1 << 18
NO_ID = (1 << 63) - 1


def runs(data: np.ndarray, starts: np.ndarray, length: int):
    """For stretches of a unit: (windows' first bytes a, b inclusive, document
    index, anchor hash, run hash, the stretch's first and last window)."""
    gram = min(GRAM, length)
    width = length - gram + 1
    bounds = np.append(starts, len(data))
    if len(data) < length:
        return
    for low in range(0, len(data) - length + 1, CHUNK):
        high = min(low + CHUNK, len(data) - length + 1)  # window starts of this stretch
        part = data[low:high + length - 1].astype(np.uint64) + np.uint64(1)
        power, inverse = _powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(part * power[: len(part)], out=sums[1:])
        grams = mix((sums[gram:] - sums[:-gram]) * inverse[: len(part) - gram + 1])
        # The place in the low bits makes the leftmost of equal hashes the least.
        least = (grams & ~np.uint64((1 << 20) - 1)) | np.arange(len(grams), dtype=np.uint64)
        have = 1
        while have < width:
            step = min(have, width - have)
            least = np.minimum(least[: len(least) - step], least[step:])
            have += step
        owner = (least[: high - low] & np.uint64((1 << 20) - 1)).astype(np.int64)
        first = np.searchsorted(bounds, low, side="right") - 1
        last = np.searchsorted(bounds, high, side="left")
        ends = bounds[first + 1:last + 1]
        inside = np.ones(high - low, dtype=bool)
        for end in ends[ends < high + length - 1].tolist():  # windows that would cross into the next document
            inside[max(0, end - length + 1 - low):max(0, end - low)] = False
        owner[~inside] = -1
        change = np.flatnonzero(np.diff(owner, prepend=-2, append=-2))
        a, b = change[:-1], change[1:] - 1
        keep = owner[a] >= 0
        a, b = a[keep], b[keep]
        if not len(a):
            continue
        p = owner[a]
        anchor = grams[p]
        whole = mix((sums[b + length] - sums[a]) * inverse[a] + (p - a).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    + (b - a).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        doc = np.searchsorted(bounds, a + low, side="right") - 1

        yield a + low, b + low, doc, anchor, whole, (low, high)


def window_hashes(data: np.ndarray, low: int, high: int, at: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the windows that start ``at`` places from ``low`` up to ``high``."""
    part = data[low:high + length - 1].astype(np.uint64) + np.uint64(1)
    power, inverse = _powers(len(part) + 1)
    sums = np.zeros(len(part) + 1, dtype=np.uint64)
    np.cumsum(part * power[: len(part)], out=sums[1:])
    at = at - low
    return mix((sums[at + length] - sums[at]) * inverse[at] + np.uint64(0xA5A5A5A5))


def _least(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the least document of each."""
    order = np.lexsort((docs, keys))
    keys, docs = keys[order], docs[order]
    first = np.flatnonzero(np.diff(keys, prepend=keys[:1] ^ np.uint64(1)) if len(keys) else keys)
    return keys[first], docs[first]


def _cells(keys: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of sorted keys by cell, and the cell of each in that order."""
    cell = (mix(keys ^ np.uint64(0x51ED270B)) % np.uint64(cells)).astype(np.int64)
    order = np.argsort(cell, kind="stable")
    return order, cell[order]


def _packed(unit: int, cell: np.ndarray, columns: list[np.ndarray]):
    """One row a cell: its columns side by side, as bytes."""
    edges = np.append(np.flatnonzero(np.diff(cell, prepend=-1)), len(cell)) if len(cell) else np.zeros(1, int)
    for x, y in zip(edges[:-1], edges[1:]):
        yield int(cell[x]), unit, b"".join(c[x:y].tobytes() for c in columns)


class Unit:
    """Texts of a unit with what has been found out about it so far."""

    def __init__(self, row: dict, cells: int, length: int):
        self.unit, self.cells = row["unit"], cells
        self.ids = np.frombuffer(row["ids"], dtype=np.int64)
        self.starts = np.frombuffer(row["starts"], dtype=np.int64)
        self.data = np.frombuffer(row["data"], dtype=np.uint8)
        self.replies = [row.get(k) for k in ("r1", "r2", "r3")]
        self.length = length

    def _answers(self, step: int, keys: np.ndarray, kind, width: int = 1) -> np.ndarray:
        """Answers to sorted keys, put back in their order."""
        order, cell = _cells(keys, self.cells)
        out = np.zeros((len(keys), width), dtype=kind)
        parts = {r["cell"]: r["data"] for r in self.replies[step] or ()}
        edges = np.append(np.flatnonzero(np.diff(cell, prepend=-1)), len(cell)) if len(cell) else np.zeros(1, int)
        for x, y in zip(edges[:-1], edges[1:]):
            out[order[x:y]] = np.frombuffer(parts[int(cell[x])], dtype=kind).reshape(width, -1).T
        return out

    def found(self):
        """All runs of the unit, in arrays, and how many are in each stretch."""
        got = list(runs(self.data, self.starts, self.length))
        if not got:
            empty = np.zeros(0, dtype=np.int64)
            return (empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)), []
        arrays = tuple(np.concatenate([g[k] for g in got]) for k in range(5))
        return arrays, [(len(g[0]), g[5]) for g in got]

    def anchors(self):
        """Step 1: cells of (anchor hashes, of which several documents)."""
        (_, _, doc, anchor, _), _ = self.found()
        keys, several = self._distinct(anchor, doc)
        order, cell = _cells(keys, self.cells)
        # Five bytes are enough to drop what is single: a clash only keeps more.
        short = (keys[order] >> np.uint64(24)).view(np.uint8).reshape(-1, 8)[:, :5]
        for c, unit, raw in _packed(self.unit, cell, [np.ascontiguousarray(short), several[order].astype(np.uint8)[:, None]]):
            yield c, unit, raw

    def _distinct(self, anchor, doc):
        low, low_doc = _least(anchor, self.ids[doc])
        high_key, high = _least(anchor, -self.ids[doc])
        return low, low_doc != -high

    def shared(self):
        """Runs whose anchor another document has too."""
        arrays, stretches = self.found()
        keys, _ = self._distinct(arrays[3], arrays[2])
        flag = self._answers(0, keys, np.uint8)[:, 0].astype(bool)
        keep = flag[np.searchsorted(keys, arrays[3])] if len(keys) else np.zeros(0, dtype=bool)
        return arrays, stretches, keep

    def runs_sent(self, arrays, keep):
        """Distinct shared runs: (run hash, least document, anchor hash), sorted by run."""
        anchor, whole, docs = arrays[3][keep], arrays[4][keep], self.ids[arrays[2][keep]]
        keys, least = _least(whole, docs)
        order = np.argsort(whole, kind="stable")
        anchors = anchor[order][np.searchsorted(whole[order], keys)]
        return keys, least, anchors

    def whole_runs(self):
        """Step 2: cells, by anchor, of distinct runs."""
        arrays, _, keep = self.shared()
        keys, least, anchors = self.runs_sent(arrays, keep)
        order, cell = _cells(anchors, self.cells)
        yield from _packed(self.unit, cell, [keys[order], least[order], anchors[order]])

    def _run_answers(self, arrays, keep):
        keys, least, anchors = self.runs_sent(arrays, keep)
        order, cell = _cells(anchors, self.cells)
        out = np.zeros((len(keys), 2), dtype=np.int64)
        parts = {r["cell"]: r["data"] for r in self.replies[1] or ()}
        edges = np.append(np.flatnonzero(np.diff(cell, prepend=-1)), len(cell)) if len(cell) else np.zeros(1, int)
        for x, y in zip(edges[:-1], edges[1:]):
            out[order[x:y]] = np.frombuffer(parts[int(cell[x])], dtype=np.int64).reshape(2, -1).T
        at = np.searchsorted(keys, arrays[4][keep])
        return out[at, 0], out[at, 1].astype(bool)

    def open_windows(self):
        """(covered runs, start, document and hash of the windows left to compare)."""
        arrays, stretches, keep = self.shared()
        a, b, doc = arrays[0], arrays[1], arrays[2]
        first = np.full(len(a), NO_ID, dtype=np.int64)
        several = np.zeros(len(a), dtype=bool)
        first[keep], several[keep] = self._run_answers(arrays, keep)
        covered = keep & (self.ids[doc] > first)
        ask = keep & several & (self.ids[doc] == first)
        starts, docs, hashes, at = [], [], [], 0
        for n, (low, high) in stretches:
            mine = np.flatnonzero(ask[at:at + n]) + at
            at += n
            if len(mine):
                size = b[mine] - a[mine] + 1
                offset = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                starts.append(np.repeat(a[mine], size) + offset)
                docs.append(np.repeat(self.ids[doc[mine]], size))
                hashes.append(window_hashes(self.data, low, high, starts[-1], self.length))
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, dtype=kind)
        return arrays, covered, join(starts, np.int64), join(docs, np.int64), join(hashes, np.uint64)

    def single_windows(self):
        """Step 3: cells of window hashes with their least document."""
        *_, docs, hashes = self.open_windows()
        keys, least = _least(hashes, docs)
        order, cell = _cells(keys, self.cells)
        yield from _packed(self.unit, cell, [keys[order], least[order]])

    def result(self):
        """(document index, bytes removed, spans, hash of the bytes kept) of every document."""
        (a, b, *_), covered, starts, docs, hashes = self.open_windows()
        keys, _ = _least(hashes, docs)
        first = self._answers(2, keys, np.int64)[:, 0]
        edge = np.zeros(len(self.data) + 1, dtype=np.int32)
        np.add.at(edge, a[covered], 1)
        np.add.at(edge, b[covered] + self.length, -1)
        if len(keys):
            gone = starts[docs > first[np.searchsorted(keys, hashes)]]
            np.add.at(edge, gone, 1)
            np.add.at(edge, gone + self.length, -1)
        removed = np.cumsum(edge[:-1]) > 0
        raw = self.data
        for k, (x, y) in enumerate(zip(self.starts, np.append(self.starts[1:], len(raw)))):
            mask = removed[x:y]
            spans = int(np.count_nonzero(np.diff(mask.astype(np.int8), prepend=0) == 1))
            yield k, int(np.count_nonzero(mask)), spans, hashlib.sha256(raw[x:y][~mask].tobytes()).hexdigest()


def _compare_anchors(rows):
    """Which anchors more than one document has."""
    raw = [np.frombuffer(data, dtype=np.uint8) for _, data in rows]
    keys, several = [], []
    for r in raw:
        n = len(r) // 6
        wide = np.zeros((n, 8), dtype=np.uint8)
        wide[:, :5] = r[: 5 * n].reshape(n, 5)
        keys.append(wide.view(np.uint64)[:, 0])
        several.append(r[5 * n:].astype(bool))
    every = np.concatenate(keys)
    known, at, count = np.unique(every, return_inverse=True, return_counts=True)
    many = count > 1
    many[at[np.concatenate(several)]] = True
    begin = 0
    for (unit, _), k in zip(rows, keys):
        yield unit, many[at[begin:begin + len(k)]].astype(np.uint8).tobytes()
        begin += len(k)


def _compare_runs(rows):
    """First document of each run, and whether its anchor has other runs."""
    parts = [np.frombuffer(data, dtype=np.uint64).reshape(3, -1) for _, data in rows]
    keys, docs, anchors = (np.concatenate([p[k] for p in parts]) for k in range(3))
    known, first = _least(keys, docs.view(np.int64))
    at = np.searchsorted(known, keys)
    of = np.zeros(len(known), dtype=np.uint64)
    of[at] = anchors
    _, group, count = np.unique(of, return_inverse=True, return_counts=True)
    several = (count > 1)[group].astype(np.int64)
    begin = 0
    for (unit, _), p in zip(rows, parts):
        mine = at[begin:begin + p.shape[1]]
        yield unit, first[mine].tobytes() + several[mine].tobytes()
        begin += p.shape[1]


def _compare_windows(rows):
    """First document of each window."""
    parts = [np.frombuffer(data, dtype=np.uint64).reshape(2, -1) for _, data in rows]
    keys, docs = (np.concatenate([p[k] for p in parts]) for k in range(2))
    known, first = _least(keys, docs.view(np.int64))
    begin = 0
    for (unit, _), p in zip(rows, parts):
        yield unit, first[np.searchsorted(known, p[0])].tobytes()


_SENT = "cell long, unit long, data binary"


def _step(units: DataFrame, replies: DataFrame | None, send: str, compare, cells: int, length: int, label: str) -> DataFrame:
    """Send what a unit has to the cells; give the answers, one row a unit."""
    def sending(batches):
        for batch in (part for whole in batches for part in slices(whole, 1)):
            for row in batch.to_pylist():
                out = list(getattr(Unit(row, cells, length), send)())
                for at in range(0, len(out), 512):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*out[at:at + 512]), (pa.int64(), pa.int64(), pa.binary()))],
                        names=["cell", "unit", "data"])

    def comparing(batches):
        cell, held = None, []

        def answers():
            found = list(compare(held)) if held else []
            for at in range(0, len(found), 512):
                part = found[at:at + 512]
                yield pa.RecordBatch.from_arrays([
                    pa.array([cell] * len(part), pa.int64()), pa.array([u for u, _ in part], pa.int64()),
                    pa.array([d for _, d in part], pa.binary())], names=["cell", "unit", "data"])

        for batch in batches:
            for c, unit, data in zip(*[batch.column(k).to_pylist() for k in range(3)]):
                if c != cell:
                    yield from answers()
                    cell, held = c, []
                held.append((unit, data))
        yield from answers()

    sent = _with(units, replies).mapInArrow(released(sending), _SENT)
    answered = sent.repartition("cell").sortWithinPartitions("cell", "unit").mapInArrow(released(comparing), _SENT)
    # One row a unit: no more than it has sent.
    return stored(answered.groupBy("unit").agg(F.collect_list(F.struct("cell", "data")).alias("reply")), label)


def _with(units: DataFrame, replies: DataFrame | None) -> DataFrame:
    return units if replies is None else units.join(replies, "unit", "left")


def _unit_rows(length: int, unit_bytes: int):
    def run(batches):
        task, made = TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0

        def packed():
            lengths = np.array([len(t) for t in texts], dtype=np.int64)
            starts = np.cumsum(lengths) - lengths
            return pa.RecordBatch.from_pydict({
                "unit": pa.array([(task << 24) + made], pa.int64()), "ids": pa.array([np.array(ids, dtype=np.int64).tobytes()], pa.binary()),
                "starts": pa.array([starts.tobytes()], pa.binary()), "data": pa.array([b"".join(texts)], pa.binary())})

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = text.encode()
                if texts and size + len(raw) > unit_bytes:
                    yield packed()
                    made, ids, texts, size = made + 1, [], [], 0
                ids.append(i)
                texts.append(raw)
                size += len(raw)
        if texts:
            yield packed()

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, unit_bytes: int = UNIT_BYTES, cell_bytes: int = CELL_BYTES) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row.

    Null text is an empty one. Of equal texts the one with the least ``doc_id``
    is compared and the others, if as long as ``length``, go as a whole. Rows
    with equal ``doc_id`` don't remove from each other; a null ``doc_id`` is
    larger than all others. Other columns are ignored; an empty table gives no
    rows; a text of any length is cut into stretches that overlap.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    rows = docs.select("doc_id", order.alias("order"), text.alias("text"), F.unhex(F.md5(text)).alias("key"))
    slim = rows.select("doc_id", "order", "key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    total = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    cells = max(16, -(-total // cell_bytes))
    texts = rows.where(F.octet_length("text") >= length).groupBy("key").agg(F.min("order").alias("id"), F.first("text").alias("text"))
    name = f"drivesync_units_{uuid.uuid4().hex}"
    made = texts.select("id", "text").mapInArrow(released(_unit_rows(length, unit_bytes)), "unit long, ids binary, starts binary, data binary")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Bucketed by unit: later joins on it move answers, not texts.
    made.write.option("parquet.page.size.row.check.min", "1").bucketBy(buckets, "unit").saveAsTable(name)
    try:
        units = spark.table(name)
        one = _step(units, None, "anchors", _compare_anchors, cells, length, "anchors").withColumnRenamed("reply", "r1")
        two = _step(units, one, "whole_runs", _compare_runs, cells, length, "runs").withColumnRenamed("reply", "r2")
        both = one.join(two, "unit", "left")
        three = _step(units, both, "single_windows", _compare_windows, cells, length, "windows").withColumnRenamed("reply", "r3")

        def applying(batches):
            for batch in (part for whole in batches for part in slices(whole, 1)):
                for row in batch.to_pylist():
                    unit = Unit(row, cells, length)
                    found = list(unit.result())
                    raw = [bytes(hashlib.md5(unit.data[x:y].tobytes()).digest()) for x, y in zip(unit.starts, np.append(unit.starts[1:], len(unit.data)))]
                    k, removed, spans, kept = zip(*found)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(raw, pa.binary()), pa.array(unit.ids, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                        pa.array(kept, pa.string())], names=["key", "id", "n_removed", "n_spans", "kept"])

        results = stored(_with(units, both.join(three, "unit", "left")).mapInArrow(
            released(applying), "key binary, id long, n_removed long, n_spans long, kept string"), "kept")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    joined = slim.join(results, "key", "left")
    copy, none = F.col("order") > F.col("id"), F.lit(hashlib.sha256(b"").hexdigest())
    pick = lambda own, gone, short: F.when(F.col("id").isNull(), short).when(copy, gone).otherwise(F.col(own))
    return joined.select(
        "doc_id", "n_bytes", pick("n_removed", F.col("n_bytes"), F.lit(0)).cast("long").alias("n_removed"),
        pick("n_spans", F.lit(1), F.lit(0)).cast("long").alias("n_spans"),
        pick("kept", none, F.col("sha")).alias("kept_sha256"))
