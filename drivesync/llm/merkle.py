"""Document fingerprints: a Merkle tree of clauses, paragraphs and sections.

Paragraphs are lines, their leaves clauses of up to 64 characters. A paragraph
hashes its leaves, a section its paragraphs, the root the sections. A section
ends after a paragraph whose hash says so, so an edit moves no other boundary.
A fingerprint is ``root|sections|leaves``: the root decides equality, the
shortened hashes below tell how much and where two texts differ.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drivesync.llm.common import stored

PARAGRAPH = "[^\\n]*\\n|[^\\n]+"
LEAF = "[^.;:!?\\n]{0,63}[.;:!?\\n]|[^.;:!?\\n]{1,64}"
SECTION = "(?:[0-9a-f]{31}[2-9a-f],)*+[0-9a-f]{31}[01],|(?:[0-9a-f]{32},)++"
SHORT = 8
# Rows of one window of neighbours, and how many windows there can be: ids are
# split at 64 quantiles and evenly between them.
BUCKET_ROWS = 2000
QUANTILES = 64
MOST_BUCKETS = 65_536


def fingerprint(text: Column) -> Column:
    """Fingerprint of a text; null is an empty text."""
    paragraphs = F.transform(
        F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PARAGRAPH), F.lit(0)),
        lambda p: F.transform(F.regexp_extract_all(p, F.lit(LEAF), F.lit(0)), lambda leaf: F.md5(leaf)))
    return _assembled(paragraphs)


def _assembled(paragraphs: Column) -> Column:
    both = F.transform(paragraphs, lambda p: F.struct(
        F.concat(F.md5(F.array_join(p, "")), F.lit(",")).alias("digest"),
        F.array_join(F.transform(p, lambda leaf: F.substring(leaf, 1, SHORT)), "").alias("leaves")))
    # aggregate() so that the parts are evaluated once
    return F.aggregate(F.array(both), F.lit(""), lambda _, b: F.aggregate(
        F.array(F.transform(F.regexp_extract_all(F.array_join(b["digest"], ""), F.lit(SECTION), F.lit(0)), lambda s: F.md5(s))),
        F.lit(""), lambda _, s: F.concat_ws(
            "|", F.sha2(F.array_join(s, ""), 256),
            F.array_join(F.transform(s, lambda x: F.substring(x, 1, SHORT)), "."), F.array_join(b["leaves"], ","))))


def _part(fingerprinted: Column, at: int, pattern: str = f"[0-9a-f]{{{SHORT}}}") -> Column:
    return F.regexp_extract_all(F.substring_index(F.substring_index(fingerprinted, "|", at), "|", -1), F.lit(pattern), F.lit(0))


def likeness(one: Column, other: Column) -> Column:
    """1 for equal roots, else twice the shared distinct leaves over the leaves of both."""
    a, b = F.array_distinct(_part(one, 3)), F.array_distinct(_part(other, 3))
    return F.when(F.substring_index(one, "|", 1) == F.substring_index(other, "|", 1), F.lit(1.0)).otherwise(
        F.lit(2.0) * F.size(F.array_intersect(a, b)) / (F.size(a) + F.size(b)))


def edited_paragraphs(one: Column, other: Column) -> Column:
    """Numbers (from 0) of the paragraphs of ``one`` whose branch ``other`` doesn't have."""
    mine, its = _part(one, 3, "[0-9a-f]+"), _part(other, 3, "[0-9a-f]+")
    return F.filter(F.transform(mine, lambda x, i: F.when(~F.array_contains(its, x), i)), lambda i: i.isNotNull())


def _buckets(ids: DataFrame) -> Column:
    """Column that puts ids in about even ranges, larger ids in larger numbers; null in -1."""
    rows, low, high = ids.agg(F.count("doc_id"), F.min("doc_id"), F.max("doc_id")).first()
    wanted = max(1, min(MOST_BUCKETS, rows // BUCKET_ROWS))
    outer = min(QUANTILES, wanted)
    inner = -(-wanted // outer)
    bounds = ids.agg(F.percentile_approx("doc_id", [k / outer for k in range(1, outer)], 10_000)).first()[0] if rows and outer > 1 else []
    bounds = sorted({low or 0, *bounds})
    spans = bounds[1:] + [(high or 0) + 1]
    at = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= F.col("doc_id")))
    first, next_ = F.element_at(F.array(*map(F.lit, bounds)), at), F.element_at(F.array(*map(F.lit, spans)), at)
    within = F.floor((F.col("doc_id") - first) / F.greatest(next_ - first, F.lit(1)) * inner)
    return F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(at * inner + F.least(within, F.lit(inner - 1))).cast("long")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of their edited texts.

    Neighbours are in order of falling ``doc_id`` (null last, ties by text).
    Null text is an empty one; other columns are ignored; a single row is its
    own neighbour; an empty table gives no rows.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    bucket = _buckets(rows.select("doc_id"))
    firsts = rows.select("doc_id", bucket.alias("bucket")).groupBy("bucket").agg(F.max("doc_id").alias("doc_id")).orderBy(
        F.desc("bucket")).collect()  # a row a bucket, at most MOST_BUCKETS
    spark = docs.sparkSession
    follows = spark.createDataFrame(
        [(a[0], b[1]) for a, b in zip(firsts, firsts[1:] + firsts[:1])],
        T.StructType([T.StructField("bucket", T.LongType()), T.StructField("next_id", docs.schema["doc_id"].dataType)]))
    # Their texts, one for each bucket: the largest text of the id, as in the order of neighbours.
    heads = stored(rows.join(F.broadcast(follows), F.col("doc_id").eqNullSafe(F.col("next_id"))).groupBy("bucket").agg(
        F.max("text").alias("head_text")).withColumn("head_print", fingerprint(F.col("head_text"))), "heads")
    order = Window.partitionBy("bucket").orderBy(F.desc_nulls_last("doc_id"), F.desc("text"))
    seen = rows.withColumn("fingerprint", fingerprint(F.col("text"))).withColumn("bucket", bucket).withColumn(
        "n", F.lead(F.struct("text", "fingerprint")).over(order))
    chars = F.char_length("text")
    joined = seen.join(heads.withColumnRenamed("bucket", "head_bucket"), (F.col("bucket") == F.col("head_bucket")) & F.col("n").isNull(), "left").select(
        "doc_id", chars.cast("long").alias("n_chars"), "fingerprint",
        F.coalesce("n.fingerprint", "head_print").alias("next_print"),
        F.concat(F.expr("substring(text, 1, char_length(text) - char_length(text) div 2)"),
                 F.expr("substring(coalesce(n.text, head_text), 1, char_length(text) div 2)")).alias("edited"))
    named = joined.withColumn("edited_fingerprint", fingerprint(F.col("edited")))
    return named.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_print")).alias("near_next"))
