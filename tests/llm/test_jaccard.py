import collections
import random
import time

import numpy as np
import pytest

from drivesync.llm import jaccardjoin
from drivesync.llm.queries import QUERIES


def grams(text, width):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute(rows, percent, width):
    """[(doc_id, n_shingles, component_id)] of (doc_id, text) rows."""
    sets = [grams(t, width) for _, t in rows]
    up = {d: d for d, _ in rows if d is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    index = collections.defaultdict(list)
    for at, (doc, _) in enumerate(rows):
        if doc is not None:
            for g in sets[at]:
                index[g].append(at)
    for at, (doc, _) in enumerate(rows):
        common = collections.Counter(other for g in sets[at] for other in (index[g] if doc is not None else ()) if other > at)
        for other, n in common.items():
            if 100 * n >= percent * (len(sets[at]) + len(sets[other]) - n):
                x, y = sorted((root(doc), root(rows[other][0])))
                up[y] = x
    return sorted(((d, len(s), None if d is None else root(d) if s else d) for (d, _), s in zip(rows, sets)), key=repr)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        rng.choice([lambda: words.insert(at, f"x{rng.random()}"), lambda: words.pop(at) if len(words) > 1 else None,
                    lambda: words.__setitem__(at, f"y{rng.random()}")])()
    return words


def corpus(seed, families=60):
    """Texts of one to 400 words with edits around the limit, chains of edits, and a shared template."""
    rng, rows = random.Random(seed), []
    template = [f"t{i}" for i in range(60)]
    for family in range(families):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.choice([1, 2, 3, 4, 5, 7, 9, 12, 15, 20, 30, 50, 80, 150, 400]))]
        if family % 7 == 0:
            words = template + words
        for _ in range(rng.randrange(1, 9)):
            rows.append(" ".join(words))
            words = edited(rng, words, rng.choice([0, 0, 1, 1, 2, max(1, len(words) // 60), max(1, len(words) // 40)]))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("percent, width", [(85, 4), (60, 2)])
def test_components_equal_brute_force(spark, percent, width):
    rows = corpus(percent)
    rows += [(1000, None), (1001, ""), (1002, " \n\t"), (None, rows[0][1]), (None, None), (3, rows[40][1]), (3, rows[40][1]), (7, "one two"), (2000, "Two\rONE two")]
    frame = spark.createDataFrame([(*r, 1, 2, "k") for r in rows], "doc_id long, text string, node int, n int, key string").repartition(6)
    got = sorted((tuple(r) for r in jaccardjoin.jaccard_join(frame, percent, width).collect()), key=repr)
    assert got == brute(rows, percent, width)


def test_odd_rows_and_empty_table(odd):
    rows = jaccardjoin.jaccard_join(odd).collect()
    assert len(rows) == odd.count() and all((r.doc_id is None) == (r.component_id is None) for r in rows)
    assert {r.component_id for r in rows if r.doc_id in (1, 4)} == {1}
    assert jaccardjoin.jaccard_join(odd.limit(0)).count() == 0


def test_a_group_of_copies_is_one_component_in_few_rounds(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(edited(rng, words, 1))) for i in range(1500)]
    found = jaccardjoin.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), 85, 4)
    assert {r.component_id for r in found.collect()} == {0}


@pytest.mark.parametrize("percent", [50, 80, 85, 95, 100])
def test_bands_segments_and_limits(percent):
    tops = jaccardjoin.band_tops(percent)
    sizes = np.arange(1, 3000)
    band = np.searchsorted(tops, sizes)
    largest = sizes * 100 // percent
    assert (np.searchsorted(tops, largest) <= band + 1).all()
    segments = jaccardjoin.differing(tops, percent) + 1
    assert (jaccardjoin.differing(sizes, percent) + 1 <= segments[band]).all()
    for size in range(1, 200):
        for other in range(1, size + 1):
            most = max((size + other - 2 * c for c in range(other + 1) if 100 * c >= percent * (size + other - c)), default=0)
            assert most <= jaccardjoin.differing(size, percent)


def test_sets_that_differ_little_share_a_key():
    """Without a cost, each choice of slots that add up to ``need`` has a key in common."""
    rng = np.random.default_rng(1)
    for size in (7, 12, 30, 90, 400):
        for _ in range(40):
            one = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
            other = np.unique(np.concatenate([one[1 + size // 25 :], rng.integers(0, 2**63, size // 25, dtype=np.uint64)]))
            segments = jaccardjoin.differing(size, 85) + 1
            open_ = int(jaccardjoin.neighbour_segments(np.array([segments]))[0])
            owner, keys, info = jaccardjoin.segment_keys(np.array([len(one), len(other)]), np.concatenate([one, other]), np.array([segments] * 2), 1)
            if len(set(one) ^ set(other)) > segments - 1:
                continue
            levels = np.ones(segments, int)
            levels[rng.permutation(open_)[: open_ // 2]] = 2
            for zero in rng.permutation(segments)[: levels.sum() - segments]:
                levels[zero] -= 1
            need = len(set(one) ^ set(other)) + 1
            if levels.sum() < need:
                continue
            mine = {k for k, o, i in zip(keys.tolist(), owner, info) if o == 0 and levels[i >> 2] >= (2 if i & 2 else 1)}
            assert mine & {k for k, o in zip(keys.tolist(), owner) if o == 1}


def test_only_sets_of_pairs_are_made(spark, monkeypatch):
    """Texts that share a phrase share keys, but few pairs of them pass the parities: the other sets stay where they are."""
    rng, made = random.Random(9), []
    rows = [(i, " ".join([f"t{k}" for k in range(9)] + [f"w{i}"])) for i in range(160)]
    near = [f"n{k}" for k in range(60)]
    rows += [(1000 + i, " ".join(edited(rng, near, i and 1))) for i in range(4)]
    stored = jaccardjoin.stored
    monkeypatch.setattr(jaccardjoin, "stored", lambda table, label: made.append((label, stored(table, label))) or made[-1][1])
    found = jaccardjoin.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), 85, 4)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(rows, 85, 4)
    live = {r.node for label, table in made if label == "live" for r in table.collect()}
    sets = [r.node for label, table in made if label == "sets" for r in table.collect()]
    assert len(live) > 150 and 4 <= len(set(sets)) == len(sets) < len(live) / 2


def test_few_texts_besides_those_asked_for_are_marked(spark):
    docs = spark.range(20000).selectExpr("nullif(id - 5000, 77) AS doc_id", "concat('text ', id) AS text", "1 AS place").repartition(5)
    for asked in (1, 40, 400):
        nodes = spark.range(asked).selectExpr("id AS node", "id * 31 - 4000 AS doc")
        rows = jaccardjoin._marked(docs, nodes, asked).collect()
        wanted = {i * 31 - 4000 for i in range(asked)} - {77}
        assert wanted <= {r.doc for r in rows} and len(rows) < 1.1 * asked + 0.05 * 20000
        assert all(r.text == f"text {r.doc + 5000}" for r in rows)


def test_a_set_moves_once_for_its_pairs_unless_they_are_many(spark):
    rows = [(1000 * b + i, b) for b in range(50) for i in range(1 + b % 9)] + [(10**6 + i, 99) for i in range(1000)]
    dealt = jaccardjoin._dealt(spark.createDataFrame(rows, "a long, b long")).collect()
    parts = collections.Counter(b for b, _ in {(r.b, r.salt) for r in dealt})
    assert sorted((r.a, r.b) for r in dealt) == sorted(rows)
    assert parts.pop(99) == 4 and set(parts.values()) == {1}


def test_shuffle_files_go_with_their_step(spark):
    def held():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        files = [files.apply(i) for i in range(files.size())]
        return {f.getName(): f.length() for f in files if f.getName().startswith("shuffle_")}

    def left():
        return sum(size for name, size in held().items() if name not in before)

    before, option = held(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(option)
    found = jaccardjoin.jaccard_join(spark.createDataFrame(corpus(3, 10), "doc_id long, text string"), 85, 4)
    until = time.monotonic() + 10
    while left() > 2000 and time.monotonic() < until:  # in the background; tests for emptiness keep a few bytes
        time.sleep(0.2)
    assert left() <= 2000 and spark.conf.get(option) == setting
    assert found.collect() == found.collect() and found.count() == len(corpus(3, 10))


def test_registered():
    assert {"op11_hard_negatives", "op12_jaccard_join", "op13_vector_codes"} <= set(QUERIES)
