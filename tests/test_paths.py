import posixpath

from helpers import as_set
from pyspark.sql import functions as F

from drivesync.functions import paths


def test_clean_path_matches_posix(spark):
    cases = [
        "//test/file.txt", "/a/../../b", "/a/./b/", "/a//b", "/", "", "a/b", "/..", "/a/b/..",
        "/a/b/../c.txt", "/.hidden/..x/y", "/a/...", "/x/../../y/./z//",
    ]
    df = spark.createDataFrame([(c,) for c in cases], "p string")
    got = dict(as_set(df, "p", paths.clean_path(F.col("p"))))
    for case in cases:
        assert got[case] == posixpath.normpath("/" + case.lstrip("/")), case


def test_parent_dir(spark):
    df = spark.createDataFrame([("/f.txt",), ("/a/b.txt",), ("/a/b/c",), ("f.txt",)], "p string")
    assert as_set(df, "p", paths.parent_dir(F.col("p"))) == {
        ("/f.txt", "/"), ("/a/b.txt", "/a"), ("/a/b/c", "/a/b"), ("f.txt", "."),
    }


def test_target_path_and_escape(spark):
    rows = [
        ("", "/test", "file.txt", "/test/file.txt", False),
        ("", None, "file.txt", "/file.txt", False),
        ("/base", "/test", "f", "/base/test/f", False),
        ("/base", "..", "f", "/f", True),
        ("/base", "/x/../../basement", "f", "/basement/f", True),
        ("/base/", "a_%b", "f", "/base/a_%b/f", False),
    ]
    df = spark.createDataFrame(rows, "b string, c string, n string, want string, out boolean")
    got = df.withColumn("p", paths.target_path(F.col("b"), F.col("c"), F.col("n")))
    got = got.withColumn("e", paths.escapes_base(F.col("p"), F.col("b")))
    for row in got.collect():
        assert (row.p, row.e) == (row.want, row.out), row


def test_ancestors(spark):
    df = spark.createDataFrame([("/a/b/c.txt",), ("/f",), ("/a_b/x",)], "path string")
    assert as_set(paths.explode_ancestors(df), "path", "ancestor") == {
        ("/a/b/c.txt", "/a"), ("/a/b/c.txt", "/a/b"), ("/a_b/x", "/a_b"),
    }


def test_no_python_in_plan(spark):
    df = spark.range(1).select(paths.clean_path(F.lit("/a/../b")))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_clean_literal_equals_the_column(spark):
    for text in ("", "/", "/a", "a/b/", "//a//b", "/a/./b/../c", "..", "/../a", "a/../../b"):
        assert spark.range(1).select(paths.clean_path(F.lit(text))).first()[0] == paths.clean_literal(text), text
