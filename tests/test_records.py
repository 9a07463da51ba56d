import json

import pytest
from helpers import as_set, chunked, entries, entry, record, records, store_hash
from pyspark.sql import functions as F

from drivesync import schemas as s
from drivesync.functions.positions import decode_position
from drivesync.operators import dispatch
from drivesync.operators.chunking import cut_chunks, plan_chunks
from drivesync.operators.records import read_json, record_json, split_records, to_records
from drivesync.operators.routing import route


def test_small_files_become_full_records(spark):
    rows = [
        entry(f"/docs/file{i}.txt", 12, tag=None, seq=i, content=b"test content") for i in (1, 2, 3)
    ]
    got = to_records(entries(spark, *rows), 1024, F.col("seq").cast("string")).collect()
    assert len(got) == 3
    for r in got:
        assert r.operation == "create" and bytes(r.payload_after) == b"test content"
        assert r.metadata[s.COLLECTION] == "/docs" and r.key.file_path == r.metadata[s.FILE_PATH]
        assert s.FILE_CHUNKED not in r.metadata and r.metadata[s.FILE_SIZE] == "12"
        position = json.loads(r.position)
        assert position["chunk_info"] is None and position["cursor"] == str(r.seq)


def test_large_file_in_five_chunks(spark):
    data = bytes(i % 251 for i in range(5000))
    rows = entries(spark, entry("/docs/large.txt", 5000, seq=1, when=7, content=data))
    got = to_records(rows, 1000, F.lit("c"), F.lit(99).cast("long")).orderBy("chunk_index").collect()
    assert [r.metadata[s.CHUNK_INDEX] for r in got] == ["1", "2", "3", "4", "5"]
    assert {r.metadata[s.CHUNK_COUNT] for r in got} == {"5"}
    assert {r.metadata[s.FILE_CHUNKED] for r in got} == {"true"}
    assert b"".join(bytes(r.payload_after) for r in got) == data
    middle, last = json.loads(got[1].position), json.loads(got[4].position)
    assert middle["chunk_info"] == {
        "file_id": "id:/docs/large.txt", "file_path": "/docs/large.txt",
        "chunk_index": 2, "total_chunks": 5,
    }
    # The file counts as processed with its last chunk only.
    assert middle["last_processed_unix_time"] == 99
    assert last["chunk_info"] is None
    assert last["last_processed_unix_time"] == (1_704_067_200 + 7) * 1_000_000_000


def test_1500_bytes_at_1024(spark):
    rows = entries(spark, entry("/f.txt", 1500, seq=1, content=b"a" * 1500))
    got = to_records(rows, 1024, F.lit("")).orderBy("chunk_index").collect()
    assert [len(r.payload_after) for r in got] == [1024, 476]
    assert got[0].metadata[s.COLLECTION] == "/"


def test_routing_and_tombstones(spark):
    rows = entries(
        spark,
        entry("/a", tag="folder", seq=1, content=b""), entry("/b", 3, tag="deleted", seq=2, content=b""),
        entry("/c", 10, tag=None, seq=3, content=b"0123456789"),
        entry("/d", 11, tag="", seq=4, content=b"0123456789x"),
        entry("/e", 0, seq=5, content=b""),
    )
    assert as_set(route(rows, 10), "path", "kind") == {
        ("/a", "dropped"), ("/b", "delete"), ("/c", "full"), ("/d", "chunked"), ("/e", "full"),
    }
    got = {r.key.file_path: r for r in to_records(rows, 10, F.lit("")).collect() if r.seq != 4}
    gone = got["/b"]
    assert gone.operation == "delete" and gone.payload_after is None
    assert set(gone.metadata) == {s.FILE_NAME, s.FILE_PATH, s.COLLECTION}
    assert bytes(got["/e"].payload_after) == b"" and "/a" not in got


@pytest.mark.parametrize("chunk", [1, 3, 64, 1000])
def test_chunks_join_to_the_file(spark, chunk):
    sizes = sorted({0, 1, chunk - 1, chunk, chunk + 1, 2 * chunk, 2 * chunk + 1})
    datas = {f"/f{n}": bytes((i * 7 + n) % 256 for i in range(n)) for n in sizes}
    rows = entries(spark, *[
        entry(p, len(c), seq=1, content=c, content_hash=store_hash(c)) for p, c in datas.items()
    ])
    got = {}
    for r in to_records(rows, chunk, F.lit("")).collect():
        got.setdefault(r.key.file_path, []).append((r.chunk_index or 0, bytes(r.payload_after)))
    assert {p: b"".join(d for _, d in sorted(parts)) for p, parts in got.items()} == datas
    for path, parts in got.items():
        size = len(datas[path])
        assert len(parts) == (1 if size <= chunk else -(-size // chunk))
    planned = as_set(plan_chunks(rows.drop("content"), chunk), "path", "chunk_index", "start", "end")
    cut = as_set(cut_chunks(rows, chunk), "path", "chunk_index", "start", "end")
    assert planned == cut


def test_resume_inside_a_file(spark):
    rows = entries(spark, entry("/a", 50, seq=1), entry("/b", 50, seq=2), entry("/c", 50, seq=3))
    saved = spark.createDataFrame([("id:/a", 2), ("id:/c", 5), ("id:/x", 1)], "id string, saved_index long")
    assert as_set(plan_chunks(rows, 10, saved), "path", "chunk_index") == {
        *[("/a", i) for i in (3, 4, 5)], *[("/b", i) for i in (1, 2, 3, 4, 5)],
    }


def test_position_round_trip(spark):
    texts = [
        '{"cursor":"c1","chunk_info":null,"last_processed_unix_time":1704067200000000000}',
        '{"cursor":"c1","chunk_info":{"file_id":"id:7","file_path":"/src1/en/7.txt",'
        '"chunk_index":2,"total_chunks":5},"last_processed_unix_time":0}',
        None,
    ]
    df = spark.createDataFrame([(t,) for t in texts], "p string")
    got = [r.d for r in df.select(decode_position(F.col("p")).alias("d")).collect()]
    assert got[0].cursor == "c1" and got[0].chunk_info is None
    assert got[0].last_processed_unix_time == 1704067200000000000
    assert got[1].chunk_info.chunk_index == 2 and got[1].chunk_info.file_path == "/src1/en/7.txt"
    assert (got[2].cursor, got[2].chunk_info, got[2].last_processed_unix_time) == ("", None, 0)


def test_bad_position_fails(spark):
    df = spark.createDataFrame([("{oops",)], "p string")
    with pytest.raises(Exception, match="(?i)malformed"):
        df.select(decode_position(F.col("p"))).collect()


def test_record_json_has_base64_payload(spark):
    rows = entries(spark, entry("/f", 2, seq=1, content=b"hi", content_hash="h"))
    text = to_records(rows, 10, F.lit("7")).select(record_json()).first()[0]
    got = json.loads(text)
    assert got["payload"] == {"before": None, "after": "aGk="}
    assert got["key"] == {"file_path": "/f"} and got["operation"] == "create"


def test_json_round_trip(spark):
    """Whole files, chunks, deletes, empty and binary payloads come back as they were."""
    rows = records(
        spark,
        record(1, bytes(range(256)), collection="/c", name='a "b"\n.bin', hash="h", size="256"),
        record(2, b"", collection="/c", name="empty", hash="h", size="0"),
        record(3, None, operation="delete", collection="/c", name="gone"),
        *chunked(4, "big", bytes(1000), 300),
    )
    lines = rows.select("seq", record_json().alias("value"))
    back = read_json(lines)
    assert back.where("record_error is not null or bad_line is not null").isEmpty()
    columns = ["seq", "position", "operation", F.to_json("metadata"), "key.file_path", "payload_before", "payload_after"]
    got, want = ([tuple(r) for r in df.select(*columns).orderBy("seq").collect()] for df in (back, rows))
    assert got == want
    good, bad = split_records(back)
    assert bad.isEmpty() and dispatch.parse_records(good).where("error is null").count() == 7
    # Without payload it is null, not an error.
    slim = read_json(rows.select(record_json(with_payload=False).alias("value")))
    assert as_set(slim, "payload_after", "record_error") == {(None, None)}


def test_bad_lines_are_rows(spark):
    good = '{"operation": "create", "key": {"file_path": "/a"}, "more": 1, "payload": {"after": "aGk="}}'
    cases = {
        None: s.ERR_NO_RECORD, "": s.ERR_NO_RECORD, "text": s.ERR_NO_RECORD, "[1]": s.ERR_NO_RECORD, good[:-20]: s.ERR_NO_RECORD,
        good.replace("aGk=", "%%"): s.ERR_NO_RECORD, good.replace('{"file_path": "/a"}', "7"): s.ERR_NO_RECORD,
        "{}": s.ERR_NO_OPERATION, good.replace("create", "merge"): s.ERR_NO_OPERATION,
        '{"operation": "delete"}': s.ERR_NO_KEY, '{"operation": "delete", "key": {}}': s.ERR_NO_KEY,
    }
    lines = spark.createDataFrame([(c, "mine", "x") for c in [good, *cases]], "value string, note string, operation string")
    back = read_json(lines)
    _, bad = split_records(back)
    assert as_set(bad, "bad_line", "record_error", "note") == {(c, e, "mine") for c, e in cases.items()}
    assert as_set(back.where("record_error is null"), "operation", "key.file_path", "payload_after", "bad_line") == {
        ("create", "/a", b"hi", None)}
    # What a torn line held is no record.
    assert back.where("record_error is not null and (operation is not null or key is not null or payload_after is not null)").isEmpty()
    assert read_json(lines.limit(0)).count() == 0
