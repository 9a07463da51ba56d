"""Line dedup by site-relative frequency.

A line (ASCII white space at its ends aside) that is on more than ``ratio`` of the
pages of its host, and on two at least, is boilerplate there and is dropped from
them. What a line is on is counted over all pages; a line twice on a page counts once.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drivesync.llm.common import stored

RATIO = 0.1
# A line on one page only repeats nothing, whatever share of its host that is.
LINE_PAGES = 2
WHITE = " \t\r\x0b\x0c"


def _lines(text):
    return F.split(text, "\n", -1)


def _bare(line):
    return F.trim(line, F.lit(WHITE))


def boilerplate(pages: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, least: int = LINE_PAGES) -> DataFrame:
    """``host, line_key, line_pages, host_pages`` of the lines to drop: at most
    the mean number of lines on a page, divided by ``ratio``, for each host."""
    lines = F.filter(F.transform(_lines(F.col(text)), _bare), lambda x: x != "")
    keys = F.array_distinct(F.transform(lines, lambda x: F.unhex(F.md5(x))))
    counted = pages.select(F.col(host).alias("host"), F.explode(keys).alias("line_key")).groupBy(
        "host", "line_key").agg(F.count("*").alias("line_pages")).where(F.col("line_pages") >= least)
    totals = pages.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("host_pages"))
    return counted.alias("c").join(totals.alias("t"), F.col("c.host").eqNullSafe(F.col("t.host"))).where(
        F.col("line_pages") > F.col("host_pages") * ratio).select("c.host", "line_key", "line_pages", "host_pages")


def drop_boilerplate(
    pages: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, least: int = LINE_PAGES,
    report: bool = False,
) -> DataFrame:
    """``pages`` with boilerplate lines gone from ``text``; with ``report``,
    ``doc_id, n_lines, n_dropped, kept_sha256, n_boilerplate`` instead, the last
    one being the lines over the ratio, also of pages that are left as they are.

    Blank lines stay. Rows and other columns stay, also those whose names
    clash with names used here. A page all of whose lines are boilerplate is
    left as it is: it is a copy as a whole, which the near-duplicate operator
    reduces to one. Null text stays null; pages with a null host are one host;
    repeated rows are pages of their own; an empty table stays empty.
    """
    # Bounded, see boilerplate(). Stored, so that Spark knows its size before it plans the join.
    found = stored(boilerplate(pages, host, text, ratio, least).groupBy("host").agg(
        F.collect_set("line_key").alias("keys")), "boilerplate").alias("b")
    kept = F.filter(_lines(F.col(f"p.{text}")), lambda x: (_bare(x) == "") | ~F.array_contains(F.col("b.keys"), F.unhex(F.md5(_bare(x)))))
    known = F.col("b.keys").isNotNull()
    lines = F.when(known & F.exists(kept, lambda x: _bare(x) != ""), kept)
    joined = pages.alias("p").join(found, F.col(f"p.{host}").eqNullSafe(F.col("b.host")), "left")
    cleaned = F.coalesce(F.array_join(lines, "\n"), F.col(f"p.{text}"))
    if report:
        n = F.size(_lines(F.col(f"p.{text}")))
        return joined.select(
            F.col("p.doc_id"), F.when(F.col(f"p.{text}").isNull(), 0).otherwise(n).cast("long").alias("n_lines"),
            F.coalesce(n - F.size(lines), F.lit(0)).cast("long").alias("n_dropped"),
            F.sha2(cleaned, 256).alias("kept_sha256"), F.coalesce(F.when(known, n - F.size(kept)), F.lit(0)).cast("long").alias("n_boilerplate"))
    return joined.select(*[cleaned.alias(c) if c == text else F.col(f"p.`{c}`") for c in pages.columns])
