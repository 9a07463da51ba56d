import os
import random

import pytest
from helpers import as_set, chunked, record, records, store_hash
from pyspark.sql import functions as F

from drivesync.operators import dispatch, tree_sink
from drivesync.operators.records import payload_records
from drivesync.sources import tree


def fill(root, files):
    for path, data in files.items():
        full = str(root) + path
        os.makedirs(os.path.dirname(full), exist_ok=True)
        with open(full, "wb") as out:
            out.write(data)


def read_all(root):
    got = {}
    for folder, _, names in os.walk(root):
        for name in names:
            full = os.path.join(folder, name)
            with open(full, "rb") as data:
                got[full[len(str(root)):]] = data.read()
    return got


def test_entries_that_vanish_cost_no_others(tmp_path):
    """A file and a folder go while a folder of 12,000 is scanned."""
    import pyarrow as pa

    root = tmp_path / "r"
    fill(root, {f"/f{i:05d}": b"" for i in range(12_000)})
    order = [item.name for item in os.scandir(root)]
    batches = tree._scan_folders(str(root))(iter([pa.record_batch([pa.array(["", "/gone"])], names=["path"])]))
    seen = next(batches).column("path").to_pylist()
    gone = order[len(seen) + 20]
    os.remove(root / gone)
    seen += [p for batch in batches for p in batch.column("path").to_pylist()]
    assert sorted(seen) == sorted(f"/{name}" for name in order if name != gone)
    lost = tree._scan_folders(str(root / "lost"))(iter([pa.record_batch([pa.array([""])], names=["path"])]))
    with pytest.raises(FileNotFoundError, match="is it mounted"):
        list(lost)


def test_list_tree(spark, tmp_path):
    fill(tmp_path, {"/a.txt": b"1", "/d/b.txt": b"22", "/d/e/c.txt": b"333", "/d/.drivesync-x": b""})
    os.makedirs(tmp_path / "empty")
    flat = tree.list_tree(spark, str(tmp_path))
    assert as_set(flat, "path", "tag") == {("/a.txt", "file"), ("/d", "folder"), ("/empty", "folder")}
    deep = tree.list_tree(spark, str(tmp_path), recursive=True)
    assert as_set(deep.where("tag = 'file'"), "path", "name", "size") == {
        ("/a.txt", "a.txt", 1), ("/d/b.txt", "b.txt", 2), ("/d/e/c.txt", "c.txt", 3),
    }
    scoped = tree.list_tree(spark, str(tmp_path), "/d", recursive=True)
    assert as_set(scoped.where("tag = 'file'"), "path") == {("/d/b.txt",), ("/d/e/c.txt",)}
    row = deep.where("path = '/a.txt'").selectExpr("unix_micros(server_modified) as t").first()
    assert row.t == os.stat(tmp_path / "a.txt").st_mtime_ns // 1000


def test_verify_folder(tmp_path):
    fill(tmp_path, {"/f": b""})
    tree.verify_folder(str(tmp_path), "")
    for path, reason in (("/f", "not a folder"), ("/x", "not found")):
        with pytest.raises(ValueError, match=reason):
            tree.verify_folder(str(tmp_path), path)


def test_hashes_and_reuse(spark, tmp_path):
    rng = random.Random(1)
    big = rng.randbytes(4 * 1024 * 1024 * 2 + 17)
    files = {"/big": big, "/edge": big[:4 * 1024 * 1024], "/empty": b"", "/s": b"test file content"}
    fill(tmp_path, files)
    listing = tree.list_tree(spark, str(tmp_path), recursive=True)
    hashed = tree.with_hashes(listing, str(tmp_path)).cache()
    assert dict(as_set(hashed, "path", "content_hash")) == {p: store_hash(d) for p, d in files.items()}
    # Unchanged files keep the hash they had, whatever is on disk now.
    known = hashed.withColumn("content_hash", F.concat(F.lit("old-"), "path"))
    fill(tmp_path, {"/s": b"longer than it was"})
    again = tree.with_hashes(tree.list_tree(spark, str(tmp_path), recursive=True), str(tmp_path), known)
    got = dict(as_set(again, "path", "content_hash"))
    assert got["/big"] == "old-/big" and got["/s"] == store_hash(b"longer than it was")


def test_tree_to_tree(spark, tmp_path):
    """Source tree to records to a replica, chunked, then a second round of changes."""
    rng = random.Random(2)
    files = {f"/d{i % 3}/f{i}": rng.randbytes(rng.choice([0, 1, 99, 100, 101, 5000])) for i in range(25)}
    source, replica = tmp_path / "s", tmp_path / "r"
    fill(source, files)
    os.makedirs(replica)

    def snapshot():
        listing = tree.with_hashes(tree.list_tree(spark, str(source), recursive=True), str(source))
        rows = tree.tree_payloads(listing, str(source), 100)
        kind = F.when(F.col("chunk_index").isNull(), "full").otherwise("chunked")
        return payload_records(rows.withColumn("kind", kind).withColumn("seq", F.lit(1).cast("long")), F.lit(""))

    done = tree_sink.apply_to_tree(dispatch.parse_records(snapshot(), "/copy"), str(replica))
    assert as_set(done, "status") == {("ok",)} and done.count() == len(files)
    assert read_all(replica) == {"/copy" + p: d for p, d in files.items()}

    # A replay changes nothing.
    tree_sink.apply_to_tree(dispatch.parse_records(snapshot(), "/copy"), str(replica))
    assert read_all(replica) == {"/copy" + p: d for p, d in files.items()}


def test_deletes_and_failures(spark, tmp_path):
    fill(tmp_path, {"/c/old": b"x", "/dir/a": b"1", "/dir/s/b": b"2", "/keep": b"k"})

    def full(seq, name, data, collection, size=None):
        return record(seq, data, collection=collection, name=name, hash=store_hash(data),
                      size=str(len(data) if size is None else size))

    rows = [
        record(1, None, "delete", collection="/c", name="old"),
        record(2, None, "delete", name="dir"),
        record(3, None, "delete", name="never-there"),
        full(4, "again", b"new", "/dir"),
        full(5, "bad", b"abc", "/c", size=9),
        *chunked(10, "big", bytes(range(256)) * 20, 100),
        record(99, None, "delete", name=""),
    ]
    done = tree_sink.apply_to_tree(dispatch.parse_records(records(spark, *rows)), str(tmp_path))
    assert as_set(done, "target_path", "status") == {
        ("/c/old", "deleted"), ("/dir", "deleted"), ("/never-there", "missing"),
        ("/dir/again", "ok"), ("/c/big", "ok"), ("/", "refused"),
    }
    assert read_all(tmp_path) == {
        "/keep": b"k", "/dir/again": b"new", "/c/big": bytes(range(256)) * 20,
    }


def test_bytes_are_read_late(spark, tmp_path):
    """The chunk plan that is shuffled holds no payload."""
    fill(tmp_path, {"/f": b"x" * 1000})
    listing = tree.list_tree(spark, str(tmp_path))
    plan = tree.tree_chunks(listing, str(tmp_path), 100)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan
    exchange = [line for line in plan.splitlines() if "Exchange" in line][0]
    assert "data" not in exchange
