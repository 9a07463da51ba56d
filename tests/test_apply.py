import random

import pytest
from helpers import as_set, chunked, record, records, store_hash

from drivesync.operators import apply, destination, dispatch
from drivesync.operators import reassemble as re

EVENTS = "path string, seq long, deleted boolean, value string"


def test_last_write_wins(spark):
    df = spark.createDataFrame([
        ("/a", 1, False, "x"), ("/a", 5, False, "y"), ("/b", 2, False, "z"), ("/b", 3, True, None),
        ("/c", 4, True, None), ("/c", 6, False, None), ("/d", 7, True, None),
    ], EVENTS)
    assert as_set(apply.apply_latest(df), "path", "seq", "value") == {("/a", 5, "y"), ("/c", 6, None)}


def test_folder_delete_takes_older_files_only(spark):
    df = spark.createDataFrame([
        ("/d/a", 1, False, "1"), ("/d/s/b", 2, False, "2"), ("/d_/c", 3, False, "3"),
        ("/d", 4, True, None), ("/d/a", 5, False, "5"), ("/d%", 6, False, "6"),
    ], EVENTS)
    assert as_set(apply.apply_latest(df), "path", "value") == {
        ("/d/a", "5"), ("/d_/c", "3"), ("/d%", "6"),
    }


def test_delete_prefixes(spark):
    files = spark.createDataFrame([("/a/b",), ("/ab",), ("/a",), ("/c/a/b",)], "path string")
    folders = spark.createDataFrame([("/a",)], "folder string")
    assert as_set(apply.delete_prefixes(files, folders), "path") == {("/ab",), ("/c/a/b",)}


def exists_at(events):
    """Plain replay: deletes of something that is not there."""
    there, missing = set(), set()
    for path, seq, deleted, _ in sorted(events, key=lambda e: e[1]):
        if not deleted:
            parts = path.split("/")[1:]
            there |= {"/" + "/".join(parts[:i]) for i in range(1, len(parts) + 1)}
        elif path in there:
            there = {p for p in there if p != path and not p.startswith(path + "/")}
        else:
            missing.add((path, seq))
    return missing


def test_missing_deletes(spark):
    rng = random.Random(5)
    paths = ["/a", "/a/b", "/a/b/c", "/a/d", "/e"]
    events = [
        (rng.choice(["/a/b/c", "/a/d", "/e"]), i, False, "v") if rng.random() < 0.5
        else (rng.choice(paths), i, True, None)
        for i in range(300)
    ]
    got = apply.missing_deletes(spark.createDataFrame(events, EVENTS))
    assert as_set(got, "path", "seq") == exists_at(events)


def content_of(spark, rows, tmp_path):
    parsed = dispatch.parse_records(records(spark, *rows))
    live = destination.live_files(parsed)
    re.store_segments(destination.file_segments(parsed, live), str(tmp_path / "s"))
    parts = re.read_segments(spark, str(tmp_path / "s"))
    got = {}
    for r in parts.orderBy("segment").collect():
        got[r.target_path] = got.get(r.target_path, b"") + bytes(r.content)
    return got


def full(seq, name, data, collection="/c"):
    return record(seq, data, collection=collection, name=name, hash=store_hash(data), size=str(len(data)))


def delete(seq, name, collection="/c"):
    return record(seq, None, "delete", collection=collection, name=name)


def test_destination_state(spark, tmp_path):
    a, b = b"a" * 40, bytes(range(100))
    rows = [
        *chunked(1, "big", a, 1),                 # 40 chunks: three segments
        full(50, "small", b"hello"), full(51, "small", b"hello again"), full(52, "empty", b""),
        *chunked(60, "twice", a, 10), *chunked(70, "twice", b, 10),
        *chunked(80, "gone", b, 10), delete(95, "gone"),
        *chunked(100, "back", b, 10), delete(115, "back"), *chunked(120, "back", b, 10),
        full(140, "f", b"1", "/dir"), full(141, "g", b"2", "/dir/sub"), delete(142, "dir", "/"),
        full(143, "h", b"3", "/dir"),
        *chunked(150, "half", b, 10)[:7],
    ]
    random.Random(1).shuffle(rows)
    assert content_of(spark, rows, tmp_path) == {
        "/c/big": a, "/c/small": b"hello again", "/c/empty": b"", "/c/twice": b, "/c/back": b,
        "/dir/h": b"3",
    }


def test_delete_amid_an_upload_cancels_it(spark, tmp_path):
    data = bytes(range(30))
    rows = chunked(1, "x", data, 10)
    # Chunk 1 came before the delete, the rest after it: not a new upload.
    rows = [rows[0], delete(2, "x")] + [
        record(r.seq + 5, bytes(r.payload_after), **{
            "collection": "/c", "name": "x", "hash": store_hash(data), "size": "30",
            "chunked": "true", "index": str(i), "count": "3"})
        for i, r in enumerate(rows[1:], 2)
    ]
    assert content_of(spark, rows, tmp_path) == {}


def test_partial_resend_does_not_beat_a_newer_version(spark, tmp_path):
    old, new = b"o" * 30, b"n" * 30
    rows = [*chunked(1, "x", old, 10), *chunked(11, "x", new, 10), chunked(21, "x", old, 10)[0]]
    assert content_of(spark, rows, tmp_path) == {"/c/x": new}


def test_wrong_size_is_reported_with_both_sizes(spark, tmp_path):
    rows = [
        record(1, b"abc", collection="/c", name="n", hash="h", size="4"),
        *[record(r.seq, bytes(r.payload_after), collection="/c", name="m", hash="k", size="9",
                 chunked="true", index=str(i), count="2")
          for i, r in enumerate(chunked(5, "m", b"abcd", 2), 1)],
    ]
    assert content_of(spark, rows, tmp_path) == {}
    parsed = dispatch.parse_records(records(spark, *rows))
    assert as_set(destination.failed_writes(parsed), "target_path", "error") == {
        ("/c/n", "corrupt file upload: stored 3, declared 4"),
        ("/c/m", "corrupt file upload: stored 4, declared 9"),
    }


@pytest.mark.parametrize("op", ["create", "update", "snapshot"])
def test_full_upload(spark, op):
    row = record(1, b"test content", op, collection="/test", name="file.txt", hash="mock-hash", size="12")
    live = destination.live_files(dispatch.parse_records(records(spark, row)))
    assert as_set(live, "target_path", "size") == {("/test/file.txt", 12)}


def test_payload_moves_once(spark):
    """Rebuilt segments are not shuffled again to find the live ones."""
    rows = chunked(1, "big", b"a" * 40, 1)
    parsed = dispatch.parse_records(records(spark, *rows))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        parts = destination.file_segments(parsed, destination.live_files(parsed))
        plan = parts.where("chunk_count > 0")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(threshold, before)
    lines = plan.splitlines()
    below = [lines[i + 1] for i, line in enumerate(lines[:-1]) if "Exchange" in line]
    assert len([line for line in below if "max_by(data" in line]) == 1
    assert not [line for line in below if "content" in line], plan
