import random

from helpers import as_set, entries, entry
from pyspark.sql import functions as F

from drivesync.operators import apply, changes


def test_diff(spark):
    old = entries(
        spark, entry("/same", 1, content_hash="h"), entry("/gone", 1, content_hash="h"),
        entry("/edit", 1, content_hash="h"), entry("/touched", 1, when=1, content_hash="h"),
    )
    new = entries(
        spark, entry("/same", 1, content_hash="h"), entry("/new", 1, content_hash="n"),
        entry("/edit", 2, content_hash="e"), entry("/touched", 1, when=9, content_hash="h"),
    )
    got = changes.diff_listings(old, new)
    assert as_set(got, "path", "change_type", "operation", "tag", "content_hash") == {
        ("/gone", "delete", "delete", "deleted", "h"),
        ("/new", "create", "create", "file", "n"),
        ("/edit", "update", "create", "file", "e"),
    }
    rows = changes.next_changes(old, new, 10).collect()
    assert sorted((r.seq, r.path) for r in rows) == [(11, "/edit"), (12, "/gone"), (13, "/new")]
    gone = [r for r in rows if r.path == "/gone"][0]
    assert (gone.id, gone.size, gone.content_hash, gone.server_modified) == (None,) * 4


def test_resync_keeps_equal_times_on_all_pages(spark):
    rows = entries(spark, *[entry(f"/f{i}", 1, when=i) for i in range(50)])
    mark = (1_704_067_200 + 20) * 1_000_000_000
    got = as_set(changes.resync_since(rows, mark), "path")
    assert got == {(f"/f{i}",) for i in range(20, 50)}
    # A mark inside a microsecond does not resend what is older.
    assert changes.resync_since(rows, mark + 1).count() == 29


def test_resync_filter_is_pushed(spark, tmp_path):
    entries(spark, entry("/a", 1)).write.parquet(str(tmp_path / "l"))
    plan = changes.resync_since(spark.read.parquet(str(tmp_path / "l")), 5)
    assert "GreaterThanOrEqual(server_modified" in plan._jdf.queryExecution().executedPlan().toString()


def test_resume_decision(spark):
    log = spark.range(100, 200).withColumnRenamed("id", "seq")
    asked = spark.createDataFrame(
        [("a", 50), ("b", 98), ("c", 99), ("d", 150), ("e", 199), ("f", 300)], "consumer string, saved long"
    )
    assert as_set(changes.resume_decision(asked, log), "consumer", "status") == {
        ("a", "resync"), ("b", "resync"), ("c", "resume"), ("d", "resume"), ("e", "up_to_date"),
        ("f", "up_to_date"),
    }


def test_mark_never_goes_back(spark):
    rows = [entry(f"/f{i}", 1, seq=i, when=w, tag=t) for i, (w, t) in enumerate(
        [(5, "file"), (9, "file"), (1, "file"), (50, "deleted"), (60, "folder"), (7, "file"), (12, "file")]
    )]
    got = changes.last_processed(entries(spark, *rows), 2, first=0)
    base = 1_704_067_200
    marks = [
        (r.batch, r.newest and int(r.newest) - base, int(r.mark) - base)
        for r in got.select(
            "batch", F.unix_timestamp("newest").alias("newest"), F.unix_timestamp("mark").alias("mark")
        ).orderBy("batch").collect()
    ]
    assert marks == [(0, 9, 9), (1, 1, 9), (2, 7, 9), (3, 12, 12)]


def test_micro_batches(spark):
    log = spark.range(1, 251).withColumnRenamed("id", "seq")
    got = log.groupBy(changes.micro_batch(F.col("seq"), 100).alias("b")).count()
    assert as_set(got, "b", "count") == {(0, 100), (1, 100), (2, 50)}


def test_compacted_log_leads_to_the_same_state(spark):
    """From every position, with folder deletes between writes below them."""
    rng = random.Random(11)
    rows = []
    for seq in range(1, 121):
        folder = f"/d{rng.randrange(3)}"
        if rng.random() < 0.1:
            rows.append(entry(folder, tag="deleted", seq=seq))
        else:
            tag = "deleted" if rng.random() < 0.2 else "file"
            rows.append(entry(f"{folder}/f{rng.randrange(6)}", seq, tag=tag, seq=seq, content_hash=f"h{seq}"))
    log = entries(spark, *rows)

    def state(events):
        flagged = events.select("path", "seq", "content_hash", (F.col("tag") == "deleted").alias("deleted"))
        return as_set(apply.apply_latest(flagged), "path", "content_hash")

    want = state(log)
    kept = log.where("seq > 80")
    part = changes.compact_log(log.where("seq <= 80"))
    assert part.columns == log.columns and part.count() == len({r["path"] for r in rows[:80]})
    for saved in (0, 1, 37, 79, 80):
        held = log.where(F.col("seq") <= saved)
        assert state(held.union(changes.changes_after(part, saved)).union(kept)) == want
    # Compacting again with what follows is compacting at once.
    again = changes.compact_log(part.union(log.where("seq > 80")))
    assert as_set(again, "path", "seq") == as_set(changes.compact_log(log), "path", "seq")


def test_resume_decision_with_compaction(spark):
    log = spark.range(100, 200).withColumnRenamed("id", "seq")
    asked = spark.createDataFrame(
        [("a", 49), ("b", 50), ("c", 98), ("d", 99), ("e", 199)], "consumer string, saved long")
    assert as_set(changes.resume_decision(asked, log, 50), "consumer", "status") == {
        ("a", "resync"), ("b", "compacted"), ("c", "compacted"), ("d", "resume"), ("e", "up_to_date")}
