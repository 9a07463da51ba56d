"""What several operators share: tables on the shared folder, hashes of words."""

import sys
import types

import numpy as np
from pyspark.sql import DataFrame

from drivesync.session import new_dir

WIDTH = 5
_SPACE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_MULTIPLIER = 0x9E3779B97F4A7C15
_BLOCK_BYTES = 1 << 20


def stored(rows: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there,
    so a lost executor costs no step before it."""
    spark = rows.sparkSession
    path = new_dir(spark, label)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def slices(batch, rows: int = 1000):
    """A batch in parts, so that what Python holds of it stays small."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _hand_back() -> None:
    """Give memory that Python no longer uses back to the system."""
    import ctypes
    import gc

    import pyarrow

    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def released(run):
    """A task function that hands memory back to the system at its end: workers
    live on, next to those of other tasks. What a worker keeps between tasks is
    that of one operator; a task of another one drops it first."""
    owner = run.__module__

    def wrapped(batches):
        state = worker_state()
        if state.get("owner", owner) != owner:
            state.clear()
            _hand_back()
        state["owner"] = owner
        try:
            yield from run(batches)
        finally:
            state.pop("powers", None)
            _hand_back()

    return wrapped


def worker_state() -> dict:
    """A dict that lives as long as the Python worker, over its tasks."""
    name = "_drivesync_worker"
    module = sys.modules.setdefault(name, types.ModuleType(name))
    return module.__dict__.setdefault("state", {})


def blocks(texts: list, limit: int = _BLOCK_BYTES):
    """Ranges of texts of about ``limit`` characters; a longer text is a range of its own."""
    begin = size = 0
    for at, text in enumerate(texts):
        more = len(text) if text else 0
        if size and size + more > limit:
            yield begin, at
            begin, size = at, 0
        size += more
    if begin < len(texts):
        yield begin, len(texts)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_numbers(count: int, seed: int) -> np.ndarray:
    """Fixed odd 64-bit multipliers."""
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(_MULTIPLIER) + np.uint64(seed)) | np.uint64(1)


def byte_tables(separators=_SPACE, alphanumeric_only: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(word byte?, byte with A-Z in lower case). With ``alphanumeric_only``
    words are runs of ASCII letters, digits and non-ASCII bytes."""
    word = np.ones(256, dtype=np.int8)
    word[list(separators)] = 0
    if alphanumeric_only:
        plain = [c for c in range(128) if not chr(c).isalnum()]
        word[plain] = 0
    lower = np.arange(256, dtype=np.uint64)
    lower[65:91] += np.uint64(32)
    return word, lower + np.uint64(1)


class Words:
    """Words of a list of texts: ``hashes``, ``doc`` (index of the text), and
    ``begin``, ``end`` in bytes of the text."""

    def __init__(self, texts: list, tables: tuple[np.ndarray, np.ndarray]):
        raw = [t.encode() if t else b"" for t in texts]
        sizes = np.array([len(r) for r in raw], dtype=np.int64)
        starts = np.zeros(len(raw), dtype=np.int64)
        np.cumsum(sizes[:-1] + 1, out=starts[1:])
        data = np.frombuffer(b"\n".join(raw), dtype=np.uint8)
        is_word, lower = tables
        mask = np.zeros(len(data) + 2, dtype=np.int8)
        mask[1:-1] = is_word[data]
        edges = np.flatnonzero(mask[1:] != mask[:-1])
        begin, end = edges[0::2], edges[1::2]
        power, inverse = _powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(lower[data] * power[: len(data)], out=sums[1:])
        self.hashes = mix((sums[end] - sums[begin]) * inverse[begin])
        self.doc = np.searchsorted(starts, begin, side="right") - 1
        self.begin, self.end = begin - starts[self.doc], end - starts[self.doc]
        self.counts = np.bincount(self.doc, minlength=len(raw)) if len(raw) else np.zeros(0, dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])

    def shingles(self, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, text index, index of the first word) of every run of ``width``
        words; a shorter text with words is one shingle."""
        n = len(self.hashes)
        left = self.first[self.doc + 1] - np.arange(n)  # words up to the end of the text
        total = np.zeros(n, dtype=np.uint64)
        for k, factor in enumerate(odd_numbers(width, 7)):
            if k < n:
                total[: n - k] += np.where(left[: n - k] > k, self.hashes[k:], np.uint64(0)) * factor
        at_start = np.arange(n) == self.first[self.doc]
        keep = np.flatnonzero((left >= width) | at_start)
        size = np.minimum(left[keep], width).astype(np.uint64)
        return mix(total[keep] + size * np.uint64(_MULTIPLIER)), self.doc[keep], keep


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    state = worker_state()
    if len(state.get("powers", ((),))[0]) < n:
        size = max(n, 2 * _BLOCK_BYTES)
        base = _MULTIPLIER
        factors = []
        for x in (base, pow(base, -1, 1 << 64)):
            step = np.full(size, x, dtype=np.uint64)
            step[0] = 1
            factors.append(np.cumprod(step))
        state["powers"] = tuple(factors)
    return state["powers"]
