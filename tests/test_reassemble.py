import random

from helpers import as_set, store_hash
from pyspark.sql import functions as F

from drivesync.operators import reassemble as re
from drivesync.operators.skew import lookup_join, running
from drivesync.operators.tree_sink import write_files
from drivesync.session import settings

CHUNKS = (
    "target_path string, hash string, chunk_count long, chunk_index long, size long, seq long, data binary"
)


def split(path, data, chunk, seq=0):
    count = max(1, -(-len(data) // chunk))
    return [
        (path, store_hash(data), count, i + 1, len(data), seq + i, data[i * chunk:(i + 1) * chunk])
        for i in range(count)
    ]


def test_any_order_copies_and_losses(spark, tmp_path):
    rng = random.Random(3)
    files, rows, lost = {}, [], set()
    for n, chunk in enumerate([1, 3, 10, 64, 100] * 6):
        size = rng.choice([0, 1, chunk - 1, chunk, chunk + 1, 2 * chunk, 2 * chunk + 1, 40 * chunk + 3])
        path, data = f"/f{n}", bytes(rng.randrange(256) for _ in range(max(size, 0)))
        parts = split(path, data, chunk)
        files[path] = data
        if len(parts) > 1 and n % 5 == 0:
            parts.pop(rng.randrange(len(parts)))
            lost.add(path)
        rows += parts + rng.choices(parts, k=3)
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, CHUNKS)
    re.store_segments(re.segments(df), str(tmp_path / "s"))
    parts = re.read_segments(spark, str(tmp_path / "s"))
    status = dict(as_set(re.manifest(parts), "target_path", "status"))
    assert {p for p, s in status.items() if s == "incomplete"} == lost
    assert {p for p, s in status.items() if s == "complete"} == set(files) - lost
    assert max(r.have for r in parts.collect()) <= re.SEGMENT_CHUNKS
    got = {}
    for r in parts.orderBy("segment").collect():
        got[r.target_path] = got.get(r.target_path, b"") + bytes(r.content)
    for block in (7, 1000):
        hashes = dict(as_set(re.hash_segments(parts, block), "target_path", "content_hash"))
        for path in set(files) - lost:
            assert got[path] == files[path]
            assert hashes[path] == store_hash(files[path], block), (path, block)
    # The payload-free manifest agrees.
    narrow = re.chunk_manifest(df.withColumn("length", F.octet_length("data").cast("long")).drop("data"))
    assert dict(as_set(narrow, "target_path", "status")) == status


def test_equal_content_at_two_paths(spark):
    data = b"same" * 50
    rows = split("/a", data, 10) + split("/b", data, 10)
    random.Random(2).shuffle(rows)
    done = re.manifest(re.segments(spark.createDataFrame(rows, CHUNKS)))
    assert as_set(done, "target_path", "status", "bytes") == {
        ("/a", "complete", 200), ("/b", "complete", 200),
    }


def test_single_chunk_file_completes(spark):
    rows = [("/one", "h", 1, 1, 3, 0, b"abc")]
    assert as_set(re.manifest(re.segments(spark.createDataFrame(rows, CHUNKS))), "status") == {("complete",)}


def test_orphans_by_age(spark):
    rows = split("/old", b"abcdef", 2, 10)[:2] + split("/new", b"abcdef", 2, 100)[:2]
    df = spark.createDataFrame(rows, CHUNKS).withColumn("length", F.octet_length("data").cast("long"))
    assert as_set(re.incomplete_files(df), "target_path") == {("/old",), ("/new",)}
    assert as_set(re.incomplete_files(df, before_seq=50), "target_path") == {("/old",)}


def arriving(spark, rows):
    return spark.createDataFrame(
        rows, "target_path string, hash string, chunk_count long, chunk_index long, length long, arrival long"
    )


def test_session_offsets(spark):
    rows = [
        ("/f", "h", 2, 1, 6, 1), ("/f", "h", 2, 2, 6, 2),      # two chunks: offsets 0 and 6
        ("/f", "h", 2, 2, 6, 3),                               # after the close
        ("/f", "h", 2, 1, 6, 4), ("/f", "h", 2, 2, 6, 5),      # opened anew
        ("/g", "h", 3, 2, 5, 1), ("/g", "h", 3, 1, 5, 2), ("/g", "h", 3, 3, 5, 3),
    ]
    got = re.session_offsets(arriving(spark, rows))
    assert as_set(got, "target_path", "arrival", "append_offset", "missing_session") == {
        ("/f", 1, 0, False), ("/f", 2, 6, False), ("/f", 3, None, True), ("/f", 4, 0, False),
        ("/f", 5, 6, False), ("/g", 1, None, True), ("/g", 2, 0, False), ("/g", 3, 5, False),
    }


def test_running_over_blocks(spark):
    """Hot and small groups, blocks far smaller than a group."""
    rng = random.Random(4)
    rows = [("hot" if rng.random() < 0.6 else f"g{rng.randrange(5)}", i, rng.randrange(100))
            for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, o long, v long")
    for inclusive in (True, False):
        got = running(df, ["g"], "o", {"s": ("sum", "v"), "m": ("max", "v")}, inclusive, width=37)
        state, want = {}, set()
        for g, o, v in rows:
            total, top = state.get(g, (0, None))
            new = (total + v, v if top is None else max(top, v))
            want.add((g, o, *(new if inclusive else (total, top))))
            state[g] = new
        assert as_set(got, "g", "o", "s", "m") == want


def test_lookup_join_keeps_all_rows(spark):
    rows = spark.range(5000).selectExpr("id", "case when id % 3 = 0 then 'hot' else concat('k', id % 50) end as k")
    look = spark.createDataFrame([("hot", 1), ("k7", 2), ("none", 3)], "k string, v int")
    hot = F.col("k") == "hot"
    for how in ("left", "inner", "left_semi", "left_anti"):
        plain = rows.join(look, "k", how)
        assert as_set(lookup_join(rows, look, ["k"], ["id"], hot, how), *plain.columns) == as_set(plain, *plain.columns)


def test_lookup_join_copies_hot_keys_only(spark):
    rows = spark.range(6000).selectExpr("id", "case when id % 3 = 0 then 'hot' else concat('k', id % 50) end as k")
    look = rows.select("k").distinct().withColumn("v", F.lit(1))
    kept = lookup_join(look, rows, ["k"], ["k"], F.lit(False), "left_semi", salts=8)
    assert kept.count() == look.count()
    # Rows of the hot key are spread, each of the others meets its one lookup row.
    assert lookup_join(rows, look, ["k"], ["id"], F.col("k") == "hot", "inner", salts=8).count() == 6000


def uneven(path, lengths, seq):
    data = random.Random(seq).randbytes(sum(lengths))
    rows, at = [], 0
    for i, length in enumerate(lengths):
        rows.append((path, store_hash(data), len(lengths), i + 1, len(data), seq + i, data[at:at + length]))
        at += length
    return data, rows


def test_chunks_of_any_length(spark, tmp_path):
    """Files whose chunks differ in length, next to those of a regular source."""
    rng = random.Random(9)
    files, rows = {}, []
    for n in range(6):
        lengths = [rng.randrange(0, 50) for _ in range(40)] if n % 2 else [7] * 39 + [3]
        files[f"/u{n}"], part = uneven(f"/u{n}", lengths, 100 * n)
        rows += part
    rng.shuffle(rows)
    re.store_segments(re.segments(spark.createDataFrame(rows, CHUNKS)), str(tmp_path / "s"))
    parts = re.read_segments(spark, str(tmp_path / "s"))
    assert as_set(re.uneven_files(parts), "target_path") == {("/u1",), ("/u3",), ("/u5",)}
    hashes = dict(as_set(re.hash_segments(parts, 64), "target_path", "content_hash"))
    assert hashes == {path: store_hash(data, 64) for path, data in files.items()}
    status = write_files(parts, str(tmp_path / "tree"))
    assert as_set(status, "target_path", "status") == {(path, "ok") for path in files}
    for path, data in files.items():
        assert (tmp_path / "tree" / path[1:]).read_bytes() == data


def test_no_payload_is_shuffled_to_place_it(spark, tmp_path):
    """Neither the write nor the hash moves content of a regular file."""
    rows = [row for n in range(3) for row in split(f"/f{n}", random.Random(n).randbytes(400), 10)]
    re.store_segments(re.segments(spark.createDataFrame(rows, CHUNKS)), str(tmp_path / "s"))
    placed = re.place_segments(re.read_segments(spark, str(tmp_path / "s")))
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_row_groups_stay_small(spark, tmp_path):
    """The writer must not gather 100 payload rows before it looks at their size."""
    import glob

    import pyarrow.parquet as pq

    rows = [(f"/f{i}", "h", 1, 1, 200_000, i, random.Random(i).randbytes(200_000)) for i in range(40)]
    parts = re.segments(spark.createDataFrame(rows, CHUNKS)).coalesce(1)
    spark._jsc.hadoopConfiguration().setInt("parquet.block.size", 1 << 20)
    try:
        re.store_segments(parts, str(tmp_path / "s"))
    finally:
        spark._jsc.hadoopConfiguration().unset("parquet.block.size")
    for file in glob.glob(str(tmp_path / "s" / "*" / "*.parquet")):
        meta = pq.read_metadata(file)
        assert max(meta.row_group(i).num_rows for i in range(meta.num_row_groups)) <= 6
