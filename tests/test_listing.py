import pytest
from helpers import as_set, entries, entry

from drivesync.sources import listing


@pytest.fixture(scope="module")
def drive(spark):
    return entries(
        spark,
        entry("/docs", tag="folder"), entry("/docs/a.txt", 1), entry("/docs/b.txt", 2),
        entry("/docs/sub/c.txt", 3), entry("/docs2/d.txt", 4), entry("/top.txt", 5),
    )


def test_folder_is_not_recursive(drive):
    assert as_set(listing.list_entries(drive, "/docs"), "path") == {("/docs/a.txt",), ("/docs/b.txt",)}
    assert as_set(listing.list_entries(drive), "path") == {("/docs",), ("/top.txt",)}


def test_recursive(drive):
    got = as_set(listing.list_entries(drive, "/docs", recursive=True), "path")
    assert got == {("/docs/a.txt",), ("/docs/b.txt",), ("/docs/sub/c.txt",)}
    assert listing.list_entries(drive, "", recursive=True).count() == 6


def test_many_folders_at_once(spark, drive):
    folders = spark.createDataFrame([("/docs",), ("/docs",), ("/docs/sub",), ("/none",)], "folder string")
    assert as_set(listing.list_folders(drive, folders), "folder", "path") == {
        ("/docs", "/docs/a.txt"), ("/docs", "/docs/b.txt"), ("/docs/sub", "/docs/sub/c.txt"),
    }
    assert listing.list_folders(drive, folders, recursive=True).count() == 4


def test_pages_cover_everything(spark):
    df = spark.range(997).selectExpr("concat('/f/', lpad(cast(id as string), 5, '0')) as path")
    pages = listing.paginate(df, 100).cache()
    want = sorted(r.path for r in df.collect())
    got = [r.path for r in pages.orderBy("rn").collect()]
    assert got == want
    assert {r.rn for r in pages.collect()} == set(range(1, 998))
    cursors = {r.page: r for r in listing.page_cursors(pages).collect()}
    assert len(cursors) == 10 and cursors[9].entries == 97
    assert [cursors[p].has_more for p in range(10)] == [True] * 9 + [False]
    # Walking page by page gives the same as the pages in one go.
    second = listing.list_page(df, 100, after=cursors[0].cursor).collect()
    assert [r.path for r in second] == want[100:200]


def test_page_plan_is_top_k(spark, drive):
    plan = listing.list_page(drive, 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_verify(spark, drive):
    asked = spark.createDataFrame(
        [("",), ("/docs",), ("/docs/sub",), ("/docs/a.txt",), ("/nope",)], "path string"
    )
    assert as_set(listing.verify_paths(asked, drive), "path", "status") == {
        ("", "ok"), ("/docs", "ok"), ("/docs/sub", "ok"), ("/docs/a.txt", "not_a_folder"),
        ("/nope", "not_found"),
    }


def test_require_folder(drive):
    listing.require_folder(drive, "")
    listing.require_folder(drive, "/docs/sub")
    with pytest.raises(ValueError, match="error verifying remote path.*not found"):
        listing.require_folder(drive, "/test-path")
    with pytest.raises(ValueError, match="not a folder"):
        listing.require_folder(drive, "/docs/a.txt")


def test_scope_reaches_the_scan(spark, drive, tmp_path):
    drive.write.parquet(str(tmp_path / "l"))
    table = spark.read.parquet(str(tmp_path / "l"))
    for recursive in (False, True):
        rows = listing.list_entries(table, "/docs", recursive).select("path")
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "StringStartsWith(path,/docs/)" in plan
        assert "ReadSchema: struct<path:string>" in plan
