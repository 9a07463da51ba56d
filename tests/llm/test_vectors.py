import collections
import math
import random

import numpy as np
import pytest

from drivesync.llm import hardneg, vectorcodes

SCHEMA = "vec_id long, embedding array<float>, label int, vector string, part int, n int, code string, score int, anchor int"


def vector_rows(count, size=8, seed=1):
    """Clustered vectors with ties, repeats, nulls and what takes no part."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.2) for _ in range(size)] for _ in range(12)]
    rows = []
    for i in range(count):
        centre = centres[i % 12]
        vector = [c + rng.gauss(0, 0.05) for c in centre]
        if i % 9 == 0:
            vector = list(centres[0])  # a tie with many
        rows.append((i, vector, None if i % 31 == 30 else i % 12 % 5))
    nan, inf = float("nan"), float("inf")
    rows += [(900, None, 1), (901, [], 1), (902, [nan] * size, 1), (903, [0.1] * (size - 1) + [inf], 2), (904, [None] + [0.1] * (size - 1), 1),
             (905, [0.1] * (size * 2), 1), (None, [0.1] * size, 1), (906, [1e9] * size, 2), rows[0], rows[50], rows[50], (50, [0.2] * size, 3)]
    return [(*r, "v", 1, 2, "c", 3, 4) for r in rows]


def whole(rows, scale):
    """(vec_id, label, whole numbers) of the rows that take part."""
    size = len(next(r[1] for r in rows if r[0] == 0))
    out = []
    for vec_id, vector, label, *_ in rows:
        if vector and len(vector) == size and all(x is not None and math.isfinite(x) for x in vector):
            out.append((vec_id, label, np.clip(np.floor(np.float32(vector).astype(float) * scale), -(1 << 21), 1 << 21)))
    return out


@pytest.mark.parametrize("run", [hardneg.hard_negatives, vectorcodes.compress])
def test_empty_and_nothing_usable(spark, run):
    assert run(spark.createDataFrame([], SCHEMA)).count() == 0
    assert run(spark.createDataFrame([(1, None, 1, *[None] * 6), (50, [], None, *[None] * 6)], SCHEMA)).count() == 0


def test_hard_negatives_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "SLAB_ROWS", 700)
    monkeypatch.setattr(hardneg, "ANCHORS", 12)
    rows = vector_rows(2000)
    got = collections.Counter(tuple(r) for r in hardneg.hard_negatives(spark.createDataFrame(rows, SCHEMA)).collect())
    known = [(i, (label + 1) % 10 if i % 7 == 0 else label, x) for i, label, x in whole(rows, 256) if i is not None and label is not None]
    want, seen = collections.Counter(), set()
    for at, (i, label, x) in enumerate(known):
        if i % 50 or (i, label, tuple(x)) in seen:
            continue
        seen.add((i, label, tuple(x)))
        scored = sorted((-int(x @ y), j, m) for k, (j, m, y) in enumerate(known) if k != at)
        for p, positive, _ in [s for s in scored if s[2] == label][:5]:
            fit = [(-s, j) for s, j, m in scored if m != label and -50 * p <= -100 * s <= -95 * p][:3]
            for rank, (score, negative) in enumerate(fit, 1):
                want[i, positive, rank, negative, -p, score] += 1
    assert got == want and len(want) > 100


def test_boxes_hold_the_products():
    rng = np.random.default_rng(3)
    rows, anchors = rng.integers(-50, 50, (600, 6)).astype(float), rng.integers(-50, 50, (9, 6)).astype(float)
    rows = rows[hardneg.tiled(rows, [2, 0, 4])]
    assert len(rows) == 600
    begin = np.arange(0, 600, hardneg.LEAF)
    low, high = hardneg.Boxes(rows, begin).bounds(anchors)
    for at, leaf in enumerate(begin):
        products = anchors @ rows[leaf : leaf + hardneg.LEAF].T
        assert (products >= low[:, [at]]).all() and (products <= high[:, [at]]).all()


def nearest(book, rows):
    far = ((rows[:, None, :] - book[None]) ** 2).sum(2)
    return far.argmin(1), far.min(1)


def test_equal_average_search_is_exact():
    rng = np.random.default_rng(5)
    for spread in (3, 100, 1 << 21):
        book = rng.integers(-spread, spread + 1, (200, 16)).astype(float)
        book[150] = book[20]
        rows = np.concatenate([rng.integers(-spread, spread + 1, (1500, 16)), book]).astype(float)
        for got, want in zip(vectorcodes.EqualAverage(book).nearest(rows), nearest(book, rows)):
            assert (got == want).all()


def test_vector_codes_equal_brute_force(spark):
    rows = vector_rows(700)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sorted((tuple(r) for r in vectorcodes.compress(frame).collect()), key=repr)
    known = whole(rows, 1024)
    x = np.array([v for _, _, v in known])
    order = sorted(range(len(known)), key=lambda k: (known[k][0] is None, known[k][0] or 0, tuple(np.float32(known[k][2]))))[:256]
    books = [x[order, 2 * p : 2 * p + 2].copy() for p in range(4)]
    for turn in range(5):
        found = [nearest(books[p], x[:, 2 * p : 2 * p + 2]) for p in range(4)]
        for p in range(4 if turn < 4 else 0):
            for entry in set(found[p][0].tolist()):
                mine = x[found[p][0] == entry, 2 * p : 2 * p + 2]
                books[p][entry] = mine.sum(0) // len(mine)
    errors = sum(f[1] for f in found).astype(int)
    by_label = collections.Counter()
    for (_, label, _), error in zip(known, errors.tolist()):
        by_label[label] += error
    digest = vectorcodes.digest(np.array(books))
    want = [(i, "".join(f"{f[0][k]:02x}" for f in found), int(errors[k]), by_label[label], digest) for k, (i, label, _) in enumerate(known)]
    assert got == sorted(want, key=repr)


def test_decode_gives_the_entries(spark):
    rows = spark.createDataFrame(vector_rows(300), SCHEMA)
    vectors = vectorcodes.usable(rows, 4)
    books = vectorcodes.fit(vectors, rounds=1)
    for r in vectorcodes.decode(vectorcodes.encode(vectors, books), books).collect():
        assert r.vector == [int(x) for p in range(4) for x in books[p, int(r.code[2 * p : 2 * p + 2], 16)]]
