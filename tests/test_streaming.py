import os
import random
import time

import pytest
from helpers import as_set, chunked, record, records, store_hash
from pyspark.sql import functions as F
from test_reassemble import CHUNKS, split
from test_tree import fill, read_all

from drivesync import schemas as s
from drivesync.operators import reassemble as re
from drivesync.operators import tree_sink
from drivesync.operators.destination import live_files
from drivesync.options import SourceOptions
from drivesync.session import settings
from drivesync.streaming import changelog, manifests, sink
from drivesync.streaming.reassembly import STATE, chunk_stream, finished_uploads, track_uploads, upload_chunks
from drivesync.streaming.source import FolderSource


class Job:
    """A folder source with its sink, as scheduled steps on one checkpoint."""

    def __init__(self, spark, base, page=3):
        self.spark = spark
        self.root, self.state, self.out = (str(base / n) for n in ("tree", "state", "out"))
        self.checkpoint = str(base / "checkpoint")
        os.makedirs(self.root)
        self.options = SourceOptions(chunk_size=100, max_entries_per_batch=page, recursive=True)

    @property
    def source(self):
        # New each time, as after a restart.
        return FolderSource(self.spark, self.root, self.state, self.options)

    def follow(self, write=None):
        query = self.source.replicate(write or sink.action_sink(self.out), self.checkpoint)
        query.awaitTermination()
        return query

    def files(self):
        return dict(as_set(sink.current_files(self.spark, self.out), "target_path", "hash"))


def test_create_modify_delete_restart(spark, tmp_path):
    rng = random.Random(1)
    job = Job(spark, tmp_path)
    files = {f"/d{i % 2}/f{i}": rng.randbytes(rng.choice([0, 10, 100, 950])) for i in range(10)}
    fill(job.root, files)
    job.source.poll()
    first = job.follow()
    assert job.files() == {p: store_hash(d) for p, d in files.items()}
    # Ten changes on pages of at most three, one page per batch.
    sizes = [p["numInputRows"] for p in first.recentProgress if p["numInputRows"]]
    assert len(sizes) >= 4

    files["/d0/f0"] = b"changed"
    files["/new"] = rng.randbytes(333)
    fill(job.root, {p: files[p] for p in ("/d0/f0", "/new")})
    for path in ("/d1/f1", "/d1/f3"):
        os.remove(job.root + path)
        del files[path]
    job.source.poll()
    assert changelog.read_log(spark, job.source.log_dir, after=10).count() == 4
    job.follow()  # a new query on the old checkpoint
    assert job.files() == {p: store_hash(d) for p, d in files.items()}
    # Nothing new, no batch; a poll without changes adds none either.
    job.source.poll()
    assert not [p for p in job.follow().recentProgress if p["numInputRows"]]


def test_failed_batch_is_run_again(spark, tmp_path):
    job = Job(spark, tmp_path)
    files = {f"/f{i}": bytes([i]) * (50 * i) for i in range(8)}
    fill(job.root, files)
    job.source.poll()
    good, seen = sink.action_sink(job.out), []

    def flaky(rows, batch_id):
        good(rows, batch_id)
        seen.append(batch_id)
        if len(seen) == 1:
            raise RuntimeError("lost before commit")

    with pytest.raises(Exception, match="lost before commit"):
        job.follow(flaky)
    job.follow(flaky)
    assert seen[:2] == [0, 0]
    actions = sink.read_actions(spark, job.out)
    chunks = sum(1 if len(d) <= 100 else -(-len(d) // 100) for d in files.values())
    assert actions.count() == chunks
    assert job.files() == {p: store_hash(d) for p, d in files.items()}


def test_replaying_a_batch_adds_nothing(spark, tmp_path):
    rows = records(
        spark, *chunked(1, "n", b"abcdef", 2), record(9, b"x", name="bad", size="1"),
        record(10, None, "delete", name="q"),
    )
    write = sink.action_sink(str(tmp_path))
    for _ in range(3):
        write(rows, 7)
    assert sink.read_actions(spark, str(tmp_path)).count() == 4
    bad = sink.read_errors(spark, str(tmp_path))
    assert as_set(bad, "seq", "error") == {(9, s.ERR_HASH_MISSING)}
    with pytest.raises(sink.StrictError, match="record 9"):
        sink.action_sink(str(tmp_path / "strict"), strict=True)(rows, 0)


def test_compaction_keeps_the_state(spark, tmp_path):
    def full(seq, name, data):
        return record(seq, data, name=name, hash=store_hash(data), size=str(len(data)))

    one = [*chunked(1, "a", b"abcdef", 2), full(5, "b", b"1"), full(6, "b", b"2"), full(7, "z", b"3")]
    two = [record(8, None, "delete", name="z"), *chunked(10, "d", b"xyzxyz", 2)[:2]]
    late = chunked(10, "d", b"xyzxyz", 2)[2:]
    write = sink.action_sink(str(tmp_path / "t"))
    write(records(spark, *one), 0)
    write(records(spark, *two), 1)
    sink.compact(spark, str(tmp_path / "t"), str(tmp_path / "u"))
    before, after = (as_set(sink.current_files(spark, str(tmp_path / n)), "target_path", "hash") for n in "tu")
    assert before == after and len(after) == 2
    assert sink.read_actions(spark, str(tmp_path / "u")).count() < 9
    # The upload in progress goes on after compaction.
    sink.action_sink(str(tmp_path / "u"))(records(spark, *late), 2)
    assert ("/c/d",) in as_set(sink.current_files(spark, str(tmp_path / "u")), "target_path")


def test_snapshot_and_missing_folder(spark, tmp_path):
    job = Job(spark, tmp_path)
    fill(job.root, {"/a": b"1", "/d/b": b"2" * 250})
    rows = job.source.snapshot()
    assert sorted(r[0] for r in rows.select("key.file_path").collect()) == ["/a"] + ["/d/b"] * 3
    flat = FolderSource(spark, job.root, job.state, SourceOptions(path="/d"))
    assert as_set(flat.list(), "path") == {("/d/b",)}
    with pytest.raises(ValueError, match="error verifying remote path"):
        FolderSource(spark, job.root, job.state, SourceOptions(path="/nope"))


def test_expired_position_relists(spark, tmp_path):
    job = Job(spark, tmp_path)
    fill(job.root, {"/a": b"1", "/b": b"2"})
    job.source.poll()
    kept = str(tmp_path / "kept")
    changelog.append_changes(None, job.source.listing(1), kept, 5, 100)
    assert as_set(changelog.open_changes(spark, kept, 101, job.source.listing(1)), "seq", "path") == {(102, "/b")}
    behind = job.source.changes_from(1).select("key.file_path")
    assert as_set(behind, "file_path") == {("/b",)}
    with pytest.raises(changelog.ExpiredPosition):
        changelog.follow(spark, kept, after=3)
    assert changelog.follow(spark, kept, after=101).isStreaming
    again = changelog.open_changes(spark, kept, 3, job.source.listing(1))
    assert as_set(again, "path") == {("/a",), ("/b",)}


def run_chunks(spark, batches, base, ttl_ms=3_600_000):
    """Each list of rows becomes a batch of the action table and one micro-batch."""
    table, out = str(base / "in"), str(base / "out")
    for number, rows in enumerate(batches):
        frame = spark.createDataFrame(rows, CHUNKS).coalesce(1).withColumnRenamed("data", "payload_after").withColumns({
            "action": F.lit("chunk"), "failed": F.lit(False), "error": F.lit(None).cast("string"),
            "length": F.octet_length("payload_after").cast("long"),
        })
        sink.write_actions(frame.select(*s.ACTION.names), f"{table}/batch_id=local-{number}", "overwrite")
        sink.start(
            track_uploads(chunk_stream(spark, table), ttl_ms), sink.session_sink(out), str(base / "ckpt")
        ).awaitTermination()
        time.sleep(0.05)
    finished = finished_uploads(sink.read_sessions(spark, out))
    re.store_segments(re.segments(upload_chunks(sink.read_actions(spark, table), finished)), str(base / "parts"))
    parts = re.read_segments(spark, str(base / "parts"))
    return parts, sink.read_orphans(spark, out), sink.read_sessions(spark, out)


def test_state_across_restarts(spark, tmp_path):
    rng = random.Random(7)
    same = rng.randbytes(230)
    files = {"/same/a": same, "/same/b": same, "/one": b"x", "/big": rng.randbytes(700)}
    rows = []
    for n, (path, data) in enumerate(files.items()):
        rows += split(path, data, 10, seq=1000 * n)
    rng.shuffle(rows)
    half = len(rows) // 2
    # Copies of early chunks come again with the later ones.
    parts, orphans, sessions = run_chunks(spark, [rows[:half], rows[half:] + rows[:20]], tmp_path)
    done = re.manifest(parts)
    assert as_set(done, "target_path", "status") == {(p, "complete") for p in files}
    hashes = dict(as_set(re.hash_segments(parts, 64), "target_path", "content_hash"))
    assert hashes == {p: store_hash(d, 64) for p, d in files.items()}
    # Each segment is reported once, with what it holds.
    assert as_set(sessions, "target_path", "segment", "have", "bytes") == as_set(parts, "target_path", "segment", "have", "bytes")
    assert sessions.count() == parts.count()
    assert orphans.count() == 0


def test_state_and_stream_hold_no_payload(spark, tmp_path):
    assert "data" not in STATE and "content" not in s.SESSION.names
    sink.action_sink(str(tmp_path))(records(spark, *chunked(1, "n", b"abcdef", 2)), 0)
    assert chunk_stream(spark, str(tmp_path)).columns == [*re.FILE_KEY, "chunk_index", "size", "seq", "length"]


def test_given_up_segments_are_reported(spark, tmp_path):
    lost = split("/lost", b"abcdef", 2)[:2]
    parts, orphans, _ = run_chunks(
        spark, [lost, split("/fine", b"abcdef", 2), split("/fine2", b"abcdef", 2)], tmp_path, ttl_ms=1
    )
    assert as_set(parts, "target_path") == {("/fine",), ("/fine2",)}
    assert as_set(orphans, "target_path", "have", "want") == {("/lost", 2, 3)}


def test_stored_actions_are_read_by_kind(spark, tmp_path):
    rows = records(spark, *chunked(1, "a", b"abcdef", 2), record(9, None, "delete", name="q"))
    sink.action_sink(str(tmp_path))(rows, 0)
    actions = sink.read_actions(spark, str(tmp_path))
    plan = actions.where("action = 'delete'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(failed" in plan and "action" in plan.split("PartitionFilters")[1]


def test_publish_to_a_tree(spark, tmp_path):
    """Stored actions to files; an upload over two batches shows when it is whole."""
    def full(seq, name, data):
        return record(seq, data, collection="/c", name=name, hash=store_hash(data), size=str(len(data)))

    table, root = str(tmp_path / "t"), tmp_path / "r"
    os.makedirs(root)
    write = sink.action_sink(table)
    big = bytes(range(256)) * 5
    parts = chunked(10, "big", big, 50)
    published = spark.createDataFrame([], "target_path string, seq long")

    write(records(spark, full(1, "a", b"1"), full(2, "b", b"2"), *parts[:9]), 0)
    status, published = tree_sink.publish(sink.read_actions(spark, table), str(root), published)
    assert as_set(status, "target_path", "status") == {("/c/a", "ok"), ("/c/b", "ok")}

    write(records(spark, full(100, "a", b"one"), record(101, None, "delete", collection="/c", name="b"),
                  *parts[9:]), 1)
    status, published = tree_sink.publish(sink.read_actions(spark, table), str(root), published)
    assert as_set(status, "target_path", "status") == {
        ("/c/a", "ok"), ("/c/b", "deleted"), ("/c/big", "ok"),
    }
    assert read_all(root) == {"/c/a": b"one", "/c/big": big}

    status, again = tree_sink.publish(sink.read_actions(spark, table), str(root), published)
    assert status.count() == 0 and as_set(again, "*") == as_set(published, "*")


def test_queries_share_a_folder(spark, tmp_path):
    """A second query, with a checkpoint of its own, replaces nothing."""
    job = Job(spark, tmp_path)
    files = {f"/f{i}": b"x" * i for i in range(6)}
    fill(job.root, files)
    job.source.poll()
    job.follow()
    more = {f"/g{i}": b"y" * i for i in range(2)}
    fill(job.root, more)
    other = FolderSource(spark, job.root, str(tmp_path / "other-state"), job.options)
    other.poll()
    other.replicate(sink.action_sink(job.out), str(tmp_path / "other-checkpoint")).awaitTermination()
    assert job.files() == {p: store_hash(d) for p, d in (files | more).items()}


def test_full_poll_sees_a_rewrite_with_the_old_time(spark, tmp_path):
    job = Job(spark, tmp_path)
    fill(tmp_path / "tree", {"/a": b"one", "/b": b"two"})
    job.source.poll()
    job.follow()
    path = tmp_path / "tree" / "a"
    before = path.stat()
    path.write_bytes(b"ONE")
    os.utime(path, ns=(before.st_atime_ns, before.st_mtime_ns))
    job.source.poll()
    job.follow()
    assert job.files() == {"/a": store_hash(b"one"), "/b": store_hash(b"two")}
    job.source.poll(full=True)
    job.follow()
    assert job.files() == {"/a": store_hash(b"ONE"), "/b": store_hash(b"two")}


def test_publish_starts_at_the_oldest_record_needed(spark, tmp_path):
    rows = [record(n, b"x", collection="/c", name=f"f{n}", hash=store_hash(b"x"), size="1") for n in range(1, 9)]
    sink.action_sink(str(tmp_path))(records(spark, *rows), 0)
    actions = sink.read_actions(spark, str(tmp_path))
    new = live_files(actions).where("seq >= 6").checkpoint()
    needed = tree_sink.records_of(actions, new)
    plan = needed._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(seq,6)" in plan
    assert as_set(needed, "seq") == {(6,), (7,), (8,)}
    assert tree_sink.records_of(actions, new.where("seq < 0")).count() == 0


def dies(*_):
    raise RuntimeError("killed")


def replica(job):
    return job.files() == {p: store_hash(d) for p, d in read_all(job.root).items()}


@pytest.mark.parametrize("step, committed", [("commit", False), ("publish", True)])
def test_poll_that_dies_leaves_no_ghosts(spark, tmp_path, monkeypatch, step, committed):
    """A poll dies, the stream runs, files change, poll and stream go on: the replica is the tree."""
    job = Job(spark, tmp_path)
    fill(job.root, {"/a": b"1", "/b": b"2"})
    job.source.poll()
    job.follow()
    fill(job.root, {"/c": b"3", "/z": b"old", "/a": b"more"})
    with monkeypatch.context() as patched:
        patched.setattr(manifests, step, dies)
        with pytest.raises(RuntimeError, match="killed"):
            job.source.poll()
    assert changelog.last_version(spark, job.source.log_dir) == 1 + committed
    assert changelog.read_log(spark, job.source.log_dir).count() == 2
    job.follow()
    assert set(job.files()) == {"/a", "/b"}
    os.remove(f"{job.root}/c")
    fill(job.root, {"/z": b"newer"})
    assert job.source.poll() == 2 + committed
    job.follow()
    assert replica(job)
    seqs = [r.seq for r in changelog.read_log(spark, job.source.log_dir).select("seq").collect()]
    assert sorted(seqs) == list(range(1, len(seqs) + 1))
    assert os.listdir(f"{job.source.log_dir}/{manifests.STAGED}") == [] or not committed


def test_half_moved_version_is_finished(spark, tmp_path, monkeypatch):
    """Stores that rename file by file may stop in the middle of a version."""
    job = Job(spark, tmp_path, page=1)
    fill(job.root, {f"/f{i}": b"x" * i for i in range(6)})
    log_dir = job.source.log_dir
    with monkeypatch.context() as patched:
        patched.setattr(manifests, "publish", dies)
        with pytest.raises(RuntimeError, match="killed"):
            job.source.poll()
    last = manifests.newest(spark, log_dir)
    staged, target = manifests.staged_dir(log_dir, last.attempt), manifests.version_dir(log_dir, 1)
    moved = [os.path.relpath(os.path.join(d, n), staged) for d, _, names in os.walk(staged) for n in names if n.endswith(".parquet")]
    assert len(moved) == last.files == 6
    for name in moved[:2]:
        os.makedirs(os.path.dirname(f"{target}/{name}"), exist_ok=True)
        os.rename(f"{staged}/{name}", f"{target}/{name}")
    assert changelog.read_log(spark, log_dir).count() == 0
    assert job.source.poll() == 1
    assert as_set(changelog.read_log(spark, log_dir), "seq") == {(n,) for n in range(1, 7)}


def test_of_two_polls_one_commits(spark, tmp_path):
    job = Job(spark, tmp_path)
    fill(job.root, {"/a": b"1"})
    job.source.poll()
    first = manifests.newest(spark, job.source.log_dir)
    with pytest.raises(manifests.VersionTaken):
        changelog.append_changes(None, job.source.listing(1), job.source.log_dir, 1, 0)
    assert manifests.newest(spark, job.source.log_dir) == first
    assert (first.rows, first.first_seq, first.last_seq, first.size) == (1, 1, 1, 1)


def test_success_markers_are_not_needed(spark, tmp_path):
    job = Job(spark, tmp_path)
    fill(job.root, {"/a": b"1"})
    with settings(spark, {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}):
        assert job.source.poll() == 1
        fill(job.root, {"/b": b"2"})
        assert job.source.poll() == 2 and job.source.poll() == 2
    job.follow()
    assert replica(job)
    plan = changelog.is_expired(spark, job.source.log_dir, 0), changelog.is_expired(spark, job.source.log_dir, -5)
    assert plan == (False, True)


def test_a_micro_batch_is_bounded_in_bytes(spark, tmp_path):
    job = Job(spark, tmp_path, page=100)
    job.options = SourceOptions(max_entries_per_batch=100, recursive=True, bytes_per_file=100)
    fill(job.root, {f"/f{i:02d}": b"x" * 30 for i in range(20)} | {"/f10x": b"y" * 5000})
    job.source.poll()
    log_dir, batches = job.source.log_dir, {}
    for file, size in read_sizes(spark, log_dir):
        batches.setdefault(file, []).append(size)
    assert [5000] in batches.values()
    assert all(sum(sizes) < 200 for sizes in batches.values() if sizes != [5000])
    assert len([p for p in job.follow().recentProgress if p["numInputRows"]]) == len(batches)
    assert replica(job)


def read_sizes(spark, log_dir):
    rows = changelog.read_log(spark, log_dir).select("_metadata.file_path", "size")
    return [tuple(r) for r in rows.collect()]


def test_lost_root_fails_the_poll(spark, tmp_path):
    job = Job(spark, tmp_path)
    fill(job.root, {"/f": b"x"})
    source = job.source
    source.poll()
    os.rename(job.root, job.root + "-gone")
    with pytest.raises(Exception, match="is it mounted"):
        source.poll()


def test_trimmed_log_stops_the_query(spark, tmp_path):
    """What was trimmed unread is missed with an error, and a resync gets it back."""
    job = Job(spark, tmp_path)
    for n in (1, 2, 3):
        fill(job.root, {f"/f{n}": b"x" * n})
        if n == 3:
            os.remove(job.root + "/f1")
        job.source.poll()
        if n == 1:
            job.follow()
    changelog.trim(spark, job.source.log_dir, 3)
    with pytest.raises(Exception, match="version 2 is no longer kept"):
        job.follow()
    held = sink.current_files(spark, job.out).select(F.col("target_path").alias("path"), F.col("hash").alias("content_hash"))
    seq = changelog.last_seq(spark, job.source.log_dir)
    missed = job.source.changes_from(1, held)
    assert as_set(missed, "seq", "key.file_path", "operation") == {
        (seq, "/f1", "delete"), (seq, "/f2", "create"), (seq, "/f3", "create"),
    }
    sink.action_sink(job.out)(missed, 0)
    assert job.files() == {"/f2": store_hash(b"xx"), "/f3": store_hash(b"xxx")}
    fill(job.root, {"/f4": b"4"})
    job.source.poll()
    job.source.replicate(sink.action_sink(job.out), str(tmp_path / "next"), after=seq).awaitTermination()
    assert set(job.files()) == {"/f2", "/f3", "/f4"}


def test_retention_keeps_what_is_unread(spark, tmp_path):
    job = Job(spark, tmp_path)
    for n in range(3):
        fill(job.root, {f"/f{n}": b"x" * n})
        job.source.poll()
    job.source.trim([job.checkpoint])
    assert changelog.committed_versions(spark, job.source.log_dir) == [3, 2, 1]
    job.follow()
    job.source.trim([job.checkpoint])
    assert changelog.committed_versions(spark, job.source.log_dir) == [3]
    fill(job.root, {"/f9": b"9"})
    assert job.source.poll() == 4
    job.follow()
    assert set(job.files()) == {"/f0", "/f1", "/f2", "/f9"}


def test_files_per_batch(spark, tmp_path):
    job = Job(spark, tmp_path, page=2)
    job.options = SourceOptions(max_entries_per_batch=2, recursive=True, files_per_batch=100)
    fill(job.root, {f"/f{i}": b"x" for i in range(12)})
    job.source.poll()
    assert len([p for p in job.follow().recentProgress if p["numInputRows"]]) == 1
    assert len(job.files()) == 12


def test_positions_carry_the_mark(spark, tmp_path):
    job = Job(spark, tmp_path)
    fill(job.root, {"/a": b"1", "/b": b"2" * 250, "/c": b"3"})
    for n, name in enumerate("abc"):
        os.utime(f"{job.root}/{name}", (1_000 + n, 1_000 + n))
    job.source.poll()
    os.remove(f"{job.root}/a")
    job.source.poll()
    rows = job.source.changes_from(0)
    last = F.get_json_object("position", "$.last_processed_unix_time").cast("long")
    got = as_set(rows.withColumn("last", last), "key.file_path", "operation", "chunk_index", "last")
    second = 1_000_000_000
    assert got >= {
        ("/b", "create", 1, 1_000 * second), ("/b", "create", 3, 1_001 * second), ("/c", "create", None, 1_002 * second),
        ("/a", "delete", None, 1_002 * second),
    }


def test_wrong_hash_is_not_stored(spark, tmp_path):
    def full(seq, name, data, declared):
        return record(seq, data, collection="/c", name=name, hash=declared, size=str(len(data)))

    rows = records(
        spark, full(1, "good", b"1", store_hash(b"1")), full(2, "bad", b"2", "0" * 64), full(3, "none", b"3", ""),
        *chunked(10, "parts", b"abcdef", 2, file_hash="f" * 64),
    )
    table, root = str(tmp_path / "t"), tmp_path / "r"
    os.makedirs(root)
    sink.action_sink(table)(rows, 0)
    assert as_set(sink.read_errors(spark, table), "seq", "error") == {(2, s.ERR_HASH_DIFFERS)}
    published = spark.createDataFrame([], "target_path string, seq long")
    status, published = tree_sink.publish(sink.read_actions(spark, table), str(root), published)
    assert as_set(status, "target_path", "status") == {
        ("/c/good", "ok"), ("/c/none", "ok"), ("/c/parts", s.ERR_HASH_DIFFERS),
    }
    assert read_all(root) == {"/c/good": b"1", "/c/none": b"3"}
    assert as_set(published, "target_path") == {("/c/good",), ("/c/none",)}


def test_strict_writes_what_precedes_the_error(spark, tmp_path):
    rows = records(
        spark, *chunked(1, "n", b"abcdef", 2), record(9, b"x", name="bad", size="1"),
        record(10, None, "delete", name="q"),
    )
    with pytest.raises(sink.StrictError, match="record 9"):
        sink.action_sink(str(tmp_path), strict=True)(rows, 0)
    assert as_set(sink.read_actions(spark, str(tmp_path)), "seq") == {(1,), (2,), (3,)}


def test_strict_evaluates_a_batch_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def noted(seq):
        seen.add(1)
        return seq

    good = [record(i, b"x", name=str(i), hash=store_hash(b"x"), size="1") for i in (1, 2, 3)]
    rows = records(spark, *good).withColumn("seq", noted("seq"))
    write = sink.action_sink(str(tmp_path), strict=True)
    write(rows, 0)
    assert seen.value == 3
    write(rows, 0)  # run again, it replaces its folder
    write(records(spark, *good).limit(0), 1)
    assert sorted(r.seq for r in sink.read_actions(spark, str(tmp_path)).collect()) == [1, 2, 3]
    assert not [n for n in os.listdir(tmp_path) if n.startswith("_judged")]


def test_failed_write_keeps_the_old_version(spark, tmp_path):
    """A folder with files where the file goes: reported, tried again, and the file is deleted later."""
    def full(seq, name, data):
        return record(seq, data, collection="/c", name=name, hash=store_hash(data), size=str(len(data)))

    table, root = str(tmp_path / "t"), tmp_path / "r"
    os.makedirs(root)
    write = sink.action_sink(table)
    publish = lambda held: tree_sink.publish(sink.read_actions(spark, table), str(root), held)
    published = spark.createDataFrame([], "target_path string, seq long")
    write(records(spark, full(1, "a", b"1")), 0)
    _, published = publish(published)
    os.remove(root / "c" / "a")
    os.makedirs(root / "c" / "a" / "x")
    (root / "c" / "a" / "x" / "kept").write_bytes(b"k")
    write(records(spark, full(2, "a", b"22")), 1)
    status, published = publish(published)
    assert status.first()["status"].startswith("failed") and as_set(published, "*") == {("/c/a", 1)}
    assert read_all(root) == {"/c/a/x/kept": b"k"}
    # Emptied, the folder gives way.
    os.remove(root / "c" / "a" / "x" / "kept")
    status, published = publish(published)
    assert as_set(status, "status") == {("ok",)} and as_set(published, "*") == {("/c/a", 2)}
    assert read_all(root) == {"/c/a": b"22"}


def test_compacted_log_spares_the_resync(spark, tmp_path, monkeypatch):
    """A consumer behind the trimmed range gets the last change of each path, deletes included."""
    job = Job(spark, tmp_path)
    log_dir = job.source.log_dir
    steps = [{"/a": b"1", "/d/b": b"2", "/d/c": b"3"}, {"/a": b"11", "/e": b"5"}, {"/a": b"111"}, {"/f": b"6"}]
    for n, files in enumerate(steps):
        if n == 2:
            os.remove(job.root + "/d/b")
        fill(job.root, files)
        job.source.poll()
        if n == 0:
            job.follow()
    whole = as_set(changelog.read_log(spark, log_dir), "seq", "path", "tag")

    # A job that dies while it compacts leaves the log as it was.
    with monkeypatch.context() as patched:
        patched.setattr(manifests, "replace_compaction", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            changelog.trim(spark, log_dir, 3, compact=True)
    assert changelog.committed_versions(spark, log_dir) == [4, 3, 2, 1]
    assert manifests.compaction(spark, log_dir) is None

    changelog.trim(spark, log_dir, 3, compact=True)
    changelog.trim(spark, log_dir, 4, compact=True)  # compacts what is compacted, too
    assert changelog.committed_versions(spark, log_dir) == [4]
    part = manifests.compaction(spark, log_dir)
    assert (part.floor, part.last_seq) == (0, 7) and len(os.listdir(f"{log_dir}/compacted")) == 1
    compacted = as_set(changelog.open_changes(spark, log_dir, 0, job.source.listing(4)), "seq", "path", "tag")
    last = {path: max(seq for seq, other, _ in whole if other == path) for _, path, _ in whole}
    assert compacted == {row for row in whole if row[0] == last[row[1]]}
    # From the middle of the trimmed range, and from the part that is kept.
    for saved in (3, 5, 7):
        rows = as_set(changelog.open_changes(spark, log_dir, saved, job.source.listing(4)), "seq", "path", "tag")
        assert rows == {row for row in compacted if row[0] > saved}

    # The replica of the first version ends like the tree.
    sink.action_sink(job.out)(job.source.changes_from(3), 77)
    assert job.files() == {p: store_hash(d) for p, d in read_all(job.root).items()}


def test_compaction_that_began_late(spark, tmp_path):
    """What was trimmed without being compacted still needs a resync."""
    job = Job(spark, tmp_path)
    for n in range(4):
        fill(job.root, {f"/f{n}": b"x" * n})
        job.source.poll()
    log_dir = job.source.log_dir
    changelog.trim(spark, log_dir, 2)
    changelog.trim(spark, log_dir, 4, compact=True)
    listing = job.source.listing(4)
    assert manifests.compaction(spark, log_dir).floor == 1
    assert as_set(changelog.open_changes(spark, log_dir, 1, listing), "seq") == {(2,), (3,), (4,)}
    # Relisted rows stand at the newest position.
    assert as_set(changelog.open_changes(spark, log_dir, 0, listing), "seq", "path") == {(4, f"/f{n}") for n in range(4)}
    # A trim that doesn't compact leaves a gap behind the compacted part.
    fill(job.root, {"/g": b"g"})
    job.source.poll()
    changelog.trim(spark, log_dir, 5)
    assert {seq for seq, in as_set(changelog.open_changes(spark, log_dir, 1, job.source.listing(5)), "seq")} == {5}
    assert changelog.compact_versions(spark, log_dir, 5).last_seq == 3
