"""Benchmark decontamination by windows that share rare shingles with an item.

Texts are words (runs of ASCII letters and digits and non-ASCII bytes, A-Z in
lower case). Windows of a document are as long as a benchmark item and are
compared with it by the weighted Jaccard similarity of the shingles, rare ones
weighing more. A window as like an item as asked lacks no more than
``1 - similarity`` of the item's weight, so it holds one of any shingles that
weigh more than that: the rarest such are the item's keys. Every window around
a key is verified, so none is lost. SimHash fingerprints rule nothing out.
"""

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drivesync.llm.common import WIDTH, Words, blocks, byte_tables, mix, released, slices

SIMILARITY = 0.8
# Bits that the fingerprints of a window and its item may differ in: all.
RADIUS = 64
# Window positions looked at in one step.
STEP = 1 << 18
# Sums of weights are compared with this much slack, then verified.
SLACK = 1e-9
# Items one pass over the documents takes: what goes to the tasks is bounded.
PASS_ITEMS = 5000


def bits_of(shingles: np.ndarray) -> np.ndarray:
    """The 64 bits of a second hash, as -1 and 1."""
    raw = mix(shingles ^ np.uint64(0x5DEECE66D)).astype("<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(raw, axis=1).astype(np.float32) * 2 - 1


def simhash(sums: np.ndarray) -> np.ndarray:
    """Eight bytes from 64 sums; a bit is set above zero."""
    return np.packbits(sums > 1e-4, axis=-1)


class Items:
    """Benchmark items, the weights of their shingles and the items of each key."""

    def __init__(self, rows: list[tuple], width: int = WIDTH, least: float = SIMILARITY):
        self.width, self.least, self.tables = width, least, byte_tables(alphanumeric_only=True)
        words = Words([text for _, text in rows], self.tables)
        hashes, doc, _ = words.shingles(width)
        self.ids = [i for i, _ in rows]
        self.sets = [dict(zip(*map(np.ndarray.tolist, np.unique(hashes[doc == k], return_counts=True)))) for k in range(len(rows))]
        known, documents = np.unique(np.concatenate([np.unique(hashes[doc == k]) for k in range(len(rows))] or [hashes]), return_counts=True)
        self.known = known
        n = max(1, len(rows))
        self.weights = np.log1p(n / documents).astype(np.float32)
        self.other = float(np.log1p(2 * n))
        self.counts = words.counts
        self.shingles, self.times, keys = [], [], []
        for k, item in enumerate(self.sets):
            shingles = np.array(sorted(item), dtype=np.uint64)
            self.shingles.append(shingles)
            self.times.append(np.array([item[s] for s in shingles.tolist()], dtype=np.float64))
            keys += [(key, k) for key in self._keys(k)]
        keys.sort()
        self.keys, begin = np.unique(np.array([key for key, _ in keys], dtype=np.uint64), return_index=True)
        self.holders = np.array([k for _, k in keys], dtype=np.int64)
        self.begin = np.append(begin, len(keys))
        self.filter = np.zeros(1 << 20, dtype=bool)
        self.filter[self.keys >> np.uint64(44)] = True

    def _keys(self, k: int) -> list[int]:
        """The rarest shingles of an item that weigh more than a window like it may lack."""
        weights = self.weigh(self.shingles[k]).astype(np.float64)
        order = np.argsort(-weights, kind="stable")
        sums = np.cumsum((weights * self.times[k])[order])
        enough = int(np.searchsorted(sums, (1 - self.least + SLACK) * sums[-1], side="right")) + 1 if len(sums) else 0
        return self.shingles[k][order[:enough]].tolist()

    @functools.cached_property
    def by_length(self) -> dict[int, tuple]:
        """Items of each length and their fingerprints."""
        out = {}
        for length in sorted({int(c) for c, s in zip(self.counts, self.sets) if s}):
            at = np.flatnonzero(self.counts == length)
            out[length] = (at, np.stack([self._print(k) for k in at]))
        return out

    def _print(self, k: int) -> np.ndarray:
        shingles = np.array(list(self.sets[k]), dtype=np.uint64)
        counts = np.array(list(self.sets[k].values()), dtype=np.float32)
        return simhash((bits_of(shingles) * (self.weigh(shingles) * counts)[:, None]).sum(0))

    def weigh(self, shingles: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.full(len(shingles), self.other, np.float32)
        at = np.minimum(np.searchsorted(self.known, shingles), len(self.known) - 1)
        return np.where(self.known[at] == shingles, self.weights[at], np.float32(self.other))

    def similarity(self, window: np.ndarray, k: int) -> float:
        """Weighted Jaccard similarity of two bags of shingles."""
        found = dict(zip(*map(np.ndarray.tolist, np.unique(window, return_counts=True))))
        item = self.sets[k]
        every = list(found.keys() | item.keys())
        weight = dict(zip(every, self.weigh(np.array(every, dtype=np.uint64)).astype(float).tolist()))
        both = sum(weight[s] * min(found[s], item[s]) for s in sorted(found.keys() & item.keys()))
        return both / sum(weight[s] * max(found.get(s, 0), item.get(s, 0)) for s in sorted(every))

    def best(self, shingles: np.ndarray, words: int, hits: np.ndarray, k: int) -> tuple | None:
        """(similarity, first word, words) of the window most like item ``k``, of
        equal ones the first, of all that hold one of ``hits``, its keys' places."""
        length = min(int(self.counts[k]), words)
        size = max(1, length - self.width + 1)
        weights = self.weigh(self.shingles[k]).astype(np.float64)
        total = float(weights @ self.times[k])
        best, places = -1.0, []
        for cut in np.split(hits, np.flatnonzero(np.diff(hits) >= 2 * size) + 1):  # no window holds keys of both sides
            low, high = max(0, int(cut[0]) - size + 1), min(len(shingles) - size, int(cut[-1]))
            part = shingles[low:high + size]
            at = np.minimum(np.searchsorted(self.shingles[k], part), len(weights) - 1)
            known = self.shingles[k][at] == part
            weight = self.weigh(part).astype(np.float64)
            shared, every = (np.concatenate([[0.0], np.cumsum(w)]) for w in (weight * known, weight))
            # Repeats count fully here, so this is no less than the similarity.
            both, all_ = (s[size:] - s[:-size] for s in (shared, every))
            maybe = np.flatnonzero(both * (1 + self.least) >= self.least * (all_ + total) - SLACK * (1 + every[-1]))
            at[~known] = len(weights)
            rows = max(1, STEP // (size + len(weights)))
            for begin in range(0, len(maybe), rows):
                starts = maybe[begin:begin + rows]
                inside = starts[:, None] + np.arange(size)
                cells = at[inside] + np.arange(len(starts))[:, None] * (len(weights) + 1)
                found = np.bincount(cells.ravel(), minlength=len(starts) * (len(weights) + 1)).reshape(len(starts), -1)[:, :-1]
                both = np.minimum(found, self.times[k]) @ weights
                alike = both / (weight[inside].sum(1) + total - both)
                top = float(alike.max())
                if top >= self.least - SLACK and top > best + SLACK:
                    best, places = top, []
                if top >= best - SLACK and best >= 0:
                    places += (starts[alike >= best - SLACK] + low).tolist()
        for start in places:  # more than one only where sums are rounded at the limit
            alike = self.similarity(shingles[start:start + size], k)
            if alike >= self.least:
                return alike, start, length
        return None

    def search(self, shingles: np.ndarray, words: int, hits: np.ndarray, keys: np.ndarray) -> dict[int, tuple]:
        """Item: (similarity, first word, words) of its best window. ``hits``: places of ``keys``."""
        places: dict[int, list] = {}
        for place, key in zip(hits.tolist(), keys.tolist()):
            for k in self.holders[self.begin[key]:self.begin[key + 1]].tolist():
                places.setdefault(k, []).append(place)
        found = {k: self.best(shingles, words, np.array(at), k) for k, at in places.items()}
        return {k: row for k, row in found.items() if row}

    def scan(self, texts: list):
        """(text index, item index, similarity, first word, words), in order."""
        if not len(self.keys):
            return
        for begin, end in blocks(texts):
            words = Words(texts[begin:end], self.tables)
            shingles, doc, _ = words.shingles(self.width)
            maybe = np.flatnonzero(self.filter[shingles >> np.uint64(44)])
            key = np.minimum(np.searchsorted(self.keys, shingles[maybe]), len(self.keys) - 1)
            sure = self.keys[key] == shingles[maybe]
            maybe, key = maybe[sure], key[sure]
            first = np.searchsorted(doc, np.arange(end - begin + 1))
            for k in np.unique(doc[maybe]).tolist():
                mine = doc[maybe] == k
                found = self.search(shingles[first[k]:first[k + 1]], int(words.counts[k]), maybe[mine] - first[k], key[mine])
                for item, (alike, start, length) in sorted(found.items()):
                    yield begin + k, item, alike, start, length


def _passes(items: DataFrame, similarity: float, limit: int):
    """Rows of the benchmark, ``limit`` at a time."""
    rows = items.select("item_id", "text")
    parts = max(1, -(-rows.count() // limit))
    for part in range(parts):
        mine = rows if parts == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        yield Items([tuple(r) for r in mine.orderBy("item_id", "text").collect()], least=similarity)


def contaminations(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, limit: int = PASS_ITEMS) -> DataFrame:
    """``doc_id, item_id, similarity, first_word, n_words``: a row for each item
    that a document holds, with its best window.

    Null and wordless texts and items match nothing. A document shorter than an
    item is one window. Repeated rows and repeated items give rows of their
    own; null ids stay null; other columns are ignored; with either table empty
    there are no rows.
    """
    schema = T.StructType([
        docs.schema["doc_id"], items.schema["item_id"], T.StructField("similarity", T.DoubleType()),
        T.StructField("first_word", T.LongType()), T.StructField("n_words", T.LongType())])
    out = None
    for index in _passes(items, similarity, limit):
        def run(batches, index=index):
            for batch in (part for whole in batches for part in slices(whole)):
                found = list(index.scan(batch.column("text").to_pylist()))
                if found:
                    at, item, *rest = map(list, zip(*found))
                    ids = [index.ids[i] for i in item]
                    yield pa.RecordBatch.from_arrays([
                        batch.column("doc_id").take(pa.array(at, pa.int64())), pa.array(ids, kind),
                        *[pa.array(c, k) for c, k in zip(rest, (pa.float64(), pa.int64(), pa.int64()))]], names=schema.names)

        from pyspark.sql.pandas.types import to_arrow_type

        kind = to_arrow_type(items.schema["item_id"].dataType)
        part = docs.select("doc_id", "text").mapInArrow(released(run), schema)
        out = part if out is None else out.unionByName(part)
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, limit: int = PASS_ITEMS) -> DataFrame:
    """``docs`` without those that hold an item. All columns and other rows stay."""
    text = docs.columns.index("text")
    for index in _passes(items, similarity, limit):
        def run(batches, index=index):
            for batch in (part for whole in batches for part in slices(whole)):
                bad = {row[0] for row in index.scan(batch.column(text).to_pylist())}
                yield batch.filter(pa.array([k not in bad for k in range(batch.num_rows)], pa.bool_())) if bad else batch

        docs = docs.mapInArrow(released(run), docs.schema)
    return docs
