"""Secret scans with an incremental ledger of blobs.

Every version of a text is a blob, addressed by its SHA-256. The ledger holds,
for each blob, which rules (name and version) have seen it and what they
found. A scan reads only the pairs of blob and rule version that it doesn't
hold, adds them, and joins all findings back to every path of a blob.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drivesync.llm.spans import find, joined
from drivesync.session import new_dir

_KEYWORDS = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word) for word in (
    "password", "passwd", "secret", "token")) + "|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
_ASSIGN = rf"(?:{_KEYWORDS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
LEDGER = "blob string, rules array<string>, findings array<struct<rule:string,start:int,end:int>>"


@dataclass(frozen=True)
class Rule:
    """A pattern; a match counts if its group ``least[0]`` has ``least[1]`` characters."""

    name: str
    version: int
    pattern: str
    least: tuple[int, int] = (0, 1)

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"

    def spans(self, text: Column) -> Column:
        found = find(text, self.pattern)
        group, size = self.least
        if group:
            found = F.filter(found, lambda s: F.length(F.regexp_extract(s["hit"], f"^{self.pattern}$", group)) >= size)
        return F.transform(found, lambda s: F.struct(F.lit(self.key).alias("rule"), s["start"].alias("start"), s["end"].alias("end")))


BASE = ("assign", "access", "hex")
# Runs below the least length are no match of their own, so it is in the pattern.
RULES = (
    Rule("assign", 1, _ASSIGN, (1, 6)),
    Rule("access", 1, "AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, "[0-9a-f]{24,}+"),
    Rule("pem", 1, "-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("hub", 1, "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", 1, "xox[abprs]-[A-Za-z0-9-]{10,}"),
)


def _read(spark, ledger: str) -> DataFrame:
    """The ledger; one that isn't there yet is empty."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.read.schema(LEDGER).parquet(ledger)
    return spark.createDataFrame([], LEDGER)


def unseen(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``blob, text, todo``: each blob once, with the rules that haven't seen it."""
    text = F.coalesce(F.col("text"), F.lit(""))
    blobs = docs.select(F.sha2(text, 256).alias("blob"), text.alias("text"))
    seen = _read(docs.sparkSession, ledger).groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_set("rules"))).alias("seen"))
    every = F.array(*[F.lit(r.key) for r in rules])
    # The slim side first: what is known needn't be sent to one place.
    missing = blobs.join(seen, "blob", "left").withColumn("todo", F.array_except(every, F.coalesce("seen", F.array().cast("array<string>"))))
    return missing.where(F.size("todo") > 0).drop("seen").dropDuplicates(["blob"])


def update(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> None:
    """Scan what the ledger at the path ``ledger`` hasn't seen and add it. An
    append is committed as a whole, so a scan that failed can be run again."""
    none = F.array().cast("array<struct<rule:string,start:int,end:int>>")
    parts = [F.when(F.array_contains("todo", r.key), r.spans(F.col("text"))).otherwise(none) for r in rules]
    unseen(docs, ledger, rules).select(
        "blob", F.col("todo").alias("rules"), F.concat(*parts).alias("findings")).write.mode("append").parquet(ledger)


def findings(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id, blob, findings`` of every row of ``docs``, from the ledger."""
    names = [r.key for r in rules]
    held = _read(docs.sparkSession, ledger).where(F.size("findings") > 0).groupBy("blob").agg(
        F.array_distinct(F.flatten(F.collect_list("findings"))).alias("all"))
    mine = held.select("blob", F.filter("all", lambda f: f["rule"].isin(names)).alias("findings"))
    paths = docs.select("doc_id", F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("blob"))
    none = F.array().cast("array<struct<rule:string,start:int,end:int>>")
    return paths.join(mine, "blob", "left").select("doc_id", "blob", F.coalesce("findings", none).alias("findings"))


def _of_rank(spans: str, rank: int) -> Column:
    return F.filter(spans, lambda s: s["rank"] == rank)


def find_secrets(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of every row.

    Without ``ledger`` a new one is begun on the shared folder. Null text is an
    empty one; null and repeated ids are rows as any other; other columns are
    ignored; an empty table gives no rows.
    """
    ledger = ledger or new_dir(docs.sparkSession, "blob-ledger")
    update(docs, ledger, rules)
    keys = F.array(*[F.lit(r.key) for r in rules])
    ranked = F.transform("findings", lambda f: F.struct(
        f["start"].alias("start"), (F.array_position(keys, f["rule"]) - 1).cast("int").alias("rank"), f["end"].alias("end")))
    kinds = tuple(r.name for r in rules)
    base = [k for k, r in enumerate(rules) if r.name in BASE]
    rows = findings(docs, ledger, rules).select("doc_id", ranked.alias("all"))
    counts = [F.size(_of_rank("all", k)).cast("long").alias(f"n_{kinds[k]}") for k in base]
    return rows.select(
        "doc_id", *counts, F.sha2(joined(F.filter("all", lambda s: s["rank"].isin(base)), kinds), 256).alias("base_sha256"),
        joined(F.col("all"), kinds).alias("spans"))
