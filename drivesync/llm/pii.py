"""Personal data: candidates by patterns, selected by gradient-boosted trees.

Exact rules give the base spans. High-recall generators propose further spans,
which may overlap; features of their format and context go to boosted trees
that learn what such data looks like (what the rules themselves look at is no
feature) from base hits, those of phones also with their country prefix hidden,
against candidates that are clearly something else. All others are undecided:
no example of anything. A threshold calibrated for precision on the examples
selects among them what the rules alone would miss, such as numbers without a
country prefix and addresses in disguise. All of it is columns; features are
few-valued, so training works on a bounded table of counts over all candidates.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drivesync.llm.common import stored
from drivesync.llm.spans import digits, find, joined, luhn

KINDS = ("email", "ip", "card", "phone")
# The base rules, written so that no text makes a search slow.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9]){13,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
GENERATORS = {
    "email": r"[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]|\{at\}) ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]|\{dot\}) ?[A-Za-z0-9-]++)*+",
    "card": r"(?<![0-9A-Za-z.-])[0-9](?:[ -]?[0-9]){12,18}+(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z.-])(?:[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3}[ .-]?[0-9]{3,4}(?![0-9A-Za-z])",
}
# What a country prefix of a base phone hit is taken to be, when it is hidden.
PREFIX = r"^\+(?:[17](?![0-9])|[0-9]{2,3}(?![0-9])|[17]|[0-9]{2})[ .-]*"
CUES = {
    "email": "(?i)mail|contact|write|address",
    "card": "(?i)card|visa|pay|account|credit",
    "phone": "(?i)phone|call|tel|fax|mobile|cell",
}
CONTEXT = 24
TREES = 24
RATE = 0.4
# Least calibrated precision, and the least number of candidates behind it.
PRECISION = 0.95
SUPPORT = 20


def _valid(kind: str, hit: Column) -> Column:
    number = digits(hit)
    if kind == "ip":
        return F.forall(F.split(hit, "\\."), lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.length(number).between(14, 19) & luhn(number)
    if kind == "phone":
        return F.length(number).between(10, 15)
    return F.lit(True)


def _guard(kind: str, text: Column) -> Column:
    return {"email": text.contains("@"), "phone": text.contains("+")}.get(kind, text.rlike(PATTERNS[kind]))


def base_spans(text: Column) -> Column:
    """Array of ``start, rank, end`` of the exact rules."""
    def of(rank: int, kind: str) -> Column:
        found = F.filter(find(text, PATTERNS[kind], _guard(kind, text)), lambda s: _valid(kind, s["hit"]))
        return F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end")))

    return F.concat(*[of(rank, kind) for rank, kind in enumerate(KINDS)])


def _of_rank(spans: Column | str, rank: int) -> Column:
    return F.filter(spans, lambda s: s["rank"] == rank)


def _features(kind: str, text: Column, s: Column) -> dict[str, Column]:
    """Few-valued features of one candidate: format, then context."""
    hit, n = s["hit"], F.length(digits(s["hit"]))
    before = F.substring(text, F.greatest(s["start"] - CONTEXT, F.lit(0)) + 1, F.least(s["start"], F.lit(CONTEXT)))
    after = F.substring(text, s["end"] + 1, F.lit(1))
    out = {
        "cue": before.rlike(CUES[kind]).cast("int"),
        "before": F.when(before == "", 0).when(before.rlike("[\\s(\\[:+]$"), 1).when(before.rlike("\\p{L}$"), 2).otherwise(3),
        "after": F.when(after == "", 0).when(after.rlike("[\\s).,;:!?]"), 1).otherwise(2),
    }
    if kind == "email":
        return out | {
            "dots": F.least(F.size(F.split(hit, "\\.|dot", -1)) - 1, F.lit(3)),
            "top": F.when(hit.rlike("(?:\\.|dot[)\\]}]) ?[A-Za-z]{2,6}$"), 1).otherwise(0),
            "name": hit.rlike("^[A-Za-z]").cast("int"),
        }
    return out | {
        "digits": F.least(F.greatest(n, F.lit(7)), F.lit(20)) - 7,
        "groups": F.least(F.size(F.split(hit, "[^0-9]+", -1)), F.lit(6)),
        "last": F.least(F.length(F.regexp_extract(hit, "[0-9]+$", 0)), F.lit(5)),
        "round": hit.contains("(").cast("int"),
    }


def _wrong(kind: str, text: Column, s: Column) -> Column:
    """Whether a candidate is clearly something else, whatever the trees say."""
    hit, number = s["hit"], digits(s["hit"])
    if kind == "email":  # a host without a domain, the end of a sentence
        return ~hit.rlike("(?:@|at[)\\]}]).*(?:\\.|dot[)\\]}])") | hit.rlike("@.*[A-Za-z0-9]\\. ")
    if kind == "card":
        return ~luhn(number)
    dotted = hit.rlike("^[0-9]{1,3}(?:\\.[0-9]{1,3}){3}$")
    date = hit.rlike("^(?:19|20)[0-9]{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12][0-9]|3[01])(?:[0-9]{4}|[0-9]{6})?$")
    return dotted | date | F.substring(text, s["start"], F.lit(1)).rlike("[$€£¥#]") & (s["start"] > 0)


def _hidden(text: Column, base: Column) -> Column:
    """Features of base phone hits without their country prefix, as they are and without brackets."""
    bare = F.transform(_of_rank(base, KINDS.index("phone")), lambda s: F.struct(
        s["end"].alias("end"), F.regexp_replace(F.substring(text, s["start"] + 1, s["end"] - s["start"]), PREFIX, "").alias("hit")))
    forms = F.flatten(F.transform(bare, lambda s: F.transform(
        F.array(s["hit"], F.regexp_replace(s["hit"], "[()]", "")), lambda hit: F.struct(
            (s["end"] - F.char_length(s["hit"])).alias("start"), s["end"].alias("end"), hit.alias("hit")))))
    alike = F.filter(forms, lambda s: s["hit"].rlike(f"^(?:{GENERATORS['phone']})$"))
    return F.transform(alike, lambda s: F.struct(*[c.cast("int").alias(n) for n, c in _features("phone", text, s).items()]))


def _candidates(kind: str, text: Column) -> Column:
    """Array of ``start, end``, whether clearly ``wrong``, and the features, packed in ``f``."""
    guard = text.rlike("@|[(\\[{]at[)\\]}]") if kind == "email" else text.rlike(GENERATORS[kind])

    def described(s: Column) -> Column:
        return F.struct(
            s["start"].alias("start"), s["end"].alias("end"), _wrong(kind, text, s).alias("wrong"),
            F.struct(*[c.cast("int").alias(n) for n, c in _features(kind, text, s).items()]).alias("f"))

    return F.transform(find(text, GENERATORS[kind], guard), described)


class Boosted:
    """Boosted trees of two levels over counted feature values.

    ``cells``: (features, candidates, positives) for each combination.
    """

    def __init__(self, names: list[str], cells: list[tuple[tuple, float, float]]):
        self.names, self.trees = names, []
        n, good = sum(c[1] for c in cells), sum(c[2] for c in cells)
        self.bias = math.log((good + 0.5) / (n - good + 0.5)) if n else -9.0
        scores = [self.bias] * len(cells)
        for _ in range(TREES if cells else 0):
            p = [1 / (1 + math.exp(-s)) for s in scores]
            gradient = [c[2] - c[1] * q for c, q in zip(cells, p)]
            weight = [c[1] * q * (1 - q) for c, q in zip(cells, p)]
            tree = self._grow(cells, gradient, weight, range(len(cells)), 2)
            self.trees.append(tree)
            scores = [s + self._value(tree, c[0]) for s, c in zip(scores, cells)]
        self.threshold = self._calibrated(cells, scores)

    def _grow(self, cells, gradient, weight, at, depth):
        at = list(at)
        g, h = sum(gradient[k] for k in at), sum(weight[k] for k in at)
        best = (1e-9, None)
        if depth:
            for f in range(len(self.names)):
                for value in sorted({cells[k][0][f] for k in at})[:-1]:
                    left = [k for k in at if cells[k][0][f] <= value]
                    gl, hl = sum(gradient[k] for k in left), sum(weight[k] for k in left)
                    gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
                    if gain > best[0]:
                        best = (gain, (f, value, left))
        if best[1] is None:
            return max(-4.0, min(4.0, RATE * g / (h + 1)))
        f, value, left = best[1]
        inside = set(left)
        return (f, value, self._grow(cells, gradient, weight, left, depth - 1),
                self._grow(cells, gradient, weight, [k for k in at if k not in inside], depth - 1))

    def _value(self, tree, features) -> float:
        while isinstance(tree, tuple):
            tree = tree[2] if features[tree[0]] <= tree[1] else tree[3]
        return tree

    def _calibrated(self, cells, scores) -> float:
        """Least score from which on, pooled over all higher, enough are right."""
        least, n, good = math.inf, 0, 0
        ranked = sorted(zip(scores, cells), key=lambda x: -x[0])
        for k, (score, (_, count, right)) in enumerate(ranked):
            n, good = n + count, good + right
            last = k + 1 == len(ranked) or ranked[k + 1][0] < score
            if last and n >= SUPPORT and good >= PRECISION * n:
                least = score
        return least

    def score(self, f: Column) -> Column:
        def node(tree) -> Column:
            if not isinstance(tree, tuple):
                return F.lit(float(tree))
            return F.when(f[self.names[tree[0]]] <= tree[1], node(tree[2])).otherwise(node(tree[3]))

        total = F.lit(float(self.bias))
        for tree in self.trees:
            total = total + node(tree)
        return total


def _overlaps(s: Column, base: Column) -> Column:
    return F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))


def _labelled(kind: str, base: Column) -> Column:
    """Features and label of the candidates that are decided."""
    own = _of_rank(base, KINDS.index(kind))
    decided = F.filter(kind, lambda s: s["wrong"] | _overlaps(s, base))
    return F.transform(decided, lambda s: F.struct(s["f"].alias("f"), _overlaps(s, own).alias("right")))


def _chosen(kind: str, model: Boosted) -> Column:
    """Undecided candidates over the threshold; they leave the base spans alone."""
    free = F.filter(kind, lambda s: ~s["wrong"] & ~_overlaps(s, F.col("base")) & (model.score(s["f"]) >= model.threshold))
    return F.transform(free, lambda s: F.struct(
        s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["end"].alias("end"), (-model.score(s["f"])).alias("loss")))


def fit(found: DataFrame) -> dict[str, Boosted]:
    """Learn from all decided candidates: those in a base span of their kind are
    right, those in one of another kind or clearly wrong by their shape are wrong.
    A phone is seen as it is and in two forms with its prefix hidden, each
    counting a third."""
    models = {}
    for kind in GENERATORS:
        decided = _labelled(kind, F.col("base"))
        share = F.lit(1.0)
        if kind == "phone":
            decided = F.concat(decided, F.transform("hidden", lambda f: F.struct(f.alias("f"), F.lit(True).alias("right"))))
            share = F.when(F.col("c.right"), 1 / 3).otherwise(1.0)
        labelled = found.where(F.size(kind) > 0).select(F.explode(decided).alias("c"))
        rows = labelled.groupBy("c.f").agg(F.sum(share), F.sum(F.when(F.col("c.right"), share).otherwise(0.0))).collect()  # a row a combination
        names = found.schema[kind].dataType.elementType["f"].dataType.names
        models[kind] = Boosted(names, sorted((tuple(r[0]), r[1], r[2]) for r in rows))
    return models


def find_personal(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` of every row.

    Null text is an empty one; null and repeated ids are rows as any other;
    other columns are ignored; an empty table gives no rows. Added spans never
    overlap a base span, and of overlapping ones the highest score stays, of
    equal scores the first.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = stored(docs.select("doc_id", text.alias("text")).select(
        "doc_id", base_spans(F.col("text")).alias("base"), *[_candidates(k, F.col("text")).alias(k) for k in GENERATORS],
        _hidden(F.col("text"), base_spans(F.col("text"))).alias("hidden")), "personal")
    return selected(found, fit(found))


def selected(found: DataFrame, models: dict[str, Boosted]) -> DataFrame:
    chosen = [_chosen(kind, model) for kind, model in models.items() if model.trees and model.threshold < math.inf]
    none = F.array().cast("array<struct<start:int,rank:int,end:int,loss:double>>")
    kept = found.withColumn("more", F.concat(none, *chosen)).withColumn("more", F.filter("more", lambda s: ~F.exists(
        "more", lambda t: (t["start"] < s["end"]) & (s["start"] < t["end"]) & (
            F.struct(t["loss"], t["start"], t["rank"], t["end"]) < F.struct(s["loss"], s["start"], s["rank"], s["end"])))))
    added = F.transform("more", lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end")))
    counts = [F.size(_of_rank("base", rank)).cast("long").alias(f"n_{kind}") for rank, kind in enumerate(KINDS)]
    return kept.select(
        "doc_id", *counts, F.sha2(joined(F.col("base"), KINDS), 256).alias("base_sha256"),
        joined(F.concat("base", added), KINDS).alias("spans"), F.size("more").cast("long").alias("n_added"))
