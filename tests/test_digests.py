import random

from helpers import as_set, entries, entry

from drivesync.operators import changes, digests


def tree(rng, count):
    return {f"/d{rng.randrange(4)}/e{rng.randrange(3)}/f{i}" if i % 5 else f"/f{i}": rng.choice("xyz") for i in range(count)}


def listing(spark, files):
    return entries(spark, *[entry(path, 1, content_hash=content) for path, content in files.items()])


def below(files, folder):
    stem = "" if folder == "/" else folder
    return {path: content for path, content in files.items() if path.startswith(stem + "/")}


def test_diff_equals_the_plain_one(spark):
    rng = random.Random(3)
    old = tree(rng, 120)
    new = dict(old)
    for path in rng.sample(sorted(old), 6):
        del new[path]
    for path in rng.sample(sorted(new), 6):
        new[path] = "edited"
    new["/d9/new"] = "n"
    a, b = listing(spark, old), listing(spark, new)
    columns = ("path", "operation", "change_type", "tag", "content_hash", "size")
    assert as_set(digests.diff_by_digests(a, b), *columns) == as_set(changes.diff_listings(a, b), *columns)

    trees = [digests.subtree_digests(digests.folder_digests(x)) for x in (a, b)]
    folders = {p.rsplit("/", n)[0] or "/" for p in (*old, *new) for n in range(1, p.count("/") + 1)}
    want = {(f, len(below(old, f)), len(below(new, f))) for f in folders if below(old, f) != below(new, f)}
    assert as_set(digests.unequal_folders(*trees), "folder", "old_files", "new_files") == want


def test_equal_and_empty_listings(spark):
    files = listing(spark, {"/a/x": "1", "/a/y": "2", "/z": None})
    none = files.limit(0)
    assert digests.diff_by_digests(files, files).count() == 0
    assert digests.diff_by_digests(none, none).count() == 0
    assert as_set(digests.diff_by_digests(none, files), "path", "change_type") == {
        ("/a/x", "create"), ("/a/y", "create"), ("/z", "create")}
    assert as_set(digests.diff_by_digests(files, none), "path", "operation") == {
        ("/a/x", "delete"), ("/a/y", "delete"), ("/z", "delete")}
    assert digests.subtree_digests(digests.folder_digests(none)).count() == 0


def test_hash_that_comes_or_swaps(spark):
    """A hash that was not known differs from an empty one; contents that change places are a change."""
    old = listing(spark, {"/a/x": None, "/b/x": "1", "/b/y": "2", "/c/x": "3"})
    new = listing(spark, {"/a/x": "", "/b/x": "2", "/b/y": "1", "/c/x": "3"})
    assert as_set(digests.diff_by_digests(old, new), "path", "change_type") == {
        ("/a/x", "update"), ("/b/x", "update"), ("/b/y", "update")}


def test_only_entries_of_unequal_folders_are_joined(spark, tmp_path):
    old = {f"/d{i}/f{j}": "same" for i in range(20) for j in range(5)}
    listing(spark, old).write.parquet(str(tmp_path / "old"))
    listing(spark, old | {"/d7/f1": "edited"}).write.parquet(str(tmp_path / "new"))
    a, b = (spark.read.parquet(str(tmp_path / n)) for n in ("old", "new"))
    seen = []

    def compare(x, y):
        seen.extend(as_set(x, "path"))
        return diff(x, y)

    diff, digests.diff_listings = digests.diff_listings, compare
    try:
        assert as_set(digests.diff_by_digests(a, b), "path") == {("/d7/f1",)}
    finally:
        digests.diff_listings = diff
    assert sorted(seen) == [(f"/d7/f{j}",) for j in range(5)]
