import pytest
from helpers import as_set, chunked, record, records

from drivesync import schemas as s
from drivesync.operators import dispatch

FULL = dict(collection="/c", name="n", hash="h", size="2")
CHUNK = dict(FULL, chunked="true", index="1", count="2")


def without(fields, key):
    return {k: v for k, v in fields.items() if k != key}


CASES = [
    (FULL, None), (CHUNK, None),
    (without(CHUNK, "index"), s.ERR_INDEX_MISSING), (dict(CHUNK, index="x"), s.ERR_INDEX_PARSE),
    (dict(CHUNK, index="1.0"), s.ERR_INDEX_PARSE), (dict(CHUNK, index=" 1"), s.ERR_INDEX_PARSE),
    (without(CHUNK, "count"), s.ERR_COUNT_MISSING), (dict(CHUNK, count="2x"), s.ERR_COUNT_PARSE),
    (without(CHUNK, "hash"), s.ERR_HASH_MISSING), (without(FULL, "hash"), s.ERR_HASH_MISSING),
    (without(FULL, "size"), s.ERR_SIZE_MISSING), (dict(FULL, size="12x"), s.ERR_SIZE_PARSE),
    (dict(FULL, size="-1"), s.ERR_SIZE_PARSE), (dict(FULL, size="+1"), s.ERR_SIZE_PARSE),
    (without(FULL, "name"), s.ERR_NAME_MISSING),
    # The first failing check names the error.
    (dict(chunked="true", index="1"), s.ERR_COUNT_MISSING),
    (dict(chunked="true"), s.ERR_INDEX_MISSING), (dict(size="1"), s.ERR_HASH_MISSING),
    # chunked other than "true" is a whole file and needs no index.
    (dict(FULL, chunked="false"), None),
    (dict(CHUNK, index="0"), s.ERR_INDEX_RANGE), (dict(CHUNK, index="3"), s.ERR_INDEX_RANGE),
    (dict(CHUNK, index="+2"), None),
    (dict(FULL, size="99999999999999999999999"), s.ERR_SIZE_PARSE),
]


def test_checks_in_order(spark):
    rows = records(spark, *[record(i, b"ab", **meta) for i, (meta, _) in enumerate(CASES)])
    got = dict(as_set(dispatch.parse_records(rows), "seq", "error"))
    assert got == {i: want for i, (_, want) in enumerate(CASES)}


def test_dispatch_and_paths(spark):
    rows = records(
        spark,
        record(1, None, "delete", name="file.txt", collection="/test"),
        record(2, b"x", "update", **CHUNK), record(3, b"x", "snapshot", **FULL),
        record(4, None, "delete", name="to_delete.txt"),
        record(5, None, "delete", collection="/test"),
        record(6, None, "delete", chunked="true", name="f"),
    )
    got = dispatch.parse_records(rows)
    assert as_set(got, "seq", "action", "target_path", "error") == {
        (1, "delete", "/test/file.txt", None), (2, "chunk", "/c/n", None), (3, "full", "/c/n", None),
        (4, "delete", "/to_delete.txt", None), (5, "delete", None, s.ERR_NAME_MISSING),
        (6, "delete", "/f", None),
    }


def test_base_folder(spark):
    rows = records(
        spark, record(1, b"ab", **FULL), record(2, b"ab", **dict(FULL, collection="/../../etc")),
        record(3, b"ab", **dict(FULL, collection="/src/deep")),
    )
    got = dispatch.parse_records(rows, "/replica", strip_prefix="/src")
    assert as_set(got, "seq", "target_path", "error") == {
        (1, "/replica/c/n", None), (2, "/etc/n", s.ERR_ESCAPE), (3, "/replica/deep/n", None),
    }


def test_prefix_ack(spark):
    rows = [("a", 0, None), ("a", 1, None), ("b", 0, None), ("b", 1, "e"), ("b", 2, None),
            ("b", 3, "e"), ("c", 0, "e")]
    df = spark.createDataFrame(rows, "batch string, pos long, error string")
    assert as_set(dispatch.prefix_ack(df), "batch", "written") == {("a", 2), ("b", 1), ("c", 0)}
    assert as_set(dispatch.acknowledged(df), "batch", "pos") == {("a", 0), ("a", 1), ("b", 0)}


def test_parsing_happens_once(spark):
    """The filter on error must not pull the parsing below it a second time."""
    rows = records(spark, *chunked(1, "n", b"abc", 1))
    plan = dispatch.split_errors(dispatch.parse_records(rows))[0]
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count(s.ERR_HASH_MISSING) == 1


def test_numbers_match_as_a_whole(spark):
    from drivesync.operators.dispatch import signed_number, unsigned_number
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([("12",), ("12\n",), (" 12",), ("-3",)], "t string")
    got = rows.select(signed_number(F.col("t")), unsigned_number(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [(12, 12), (None, None), (None, None), (-3, None)]
