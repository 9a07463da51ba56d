"""Language identification by error-correcting output codes.

Every language has a codeword; a binary classifier for each of its bits, a
logistic model over hashed letter n-grams, is learned from a bounded sample.
A text goes to the codeword of least loss, each bit weighted by how often its
classifier is right on that language; a near tie is flagged as ambiguous.
"""

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drivesync.llm.common import released, slices

UNKNOWN = "und"
# Labelled rows a language the classifiers are fitted on, at most (in expectation).
SAMPLE_ROWS = 500
FEATURES = 8192
GRAMS = (1, 2, 3, 4)
STEPS = 200
# Below this share of the two best codewords a decision is ambiguous.
LEAST_SCORE = 0.55
# Letters below which an ambiguous text isn't rejected: too little to tell.
REJECT_LETTERS = 40


def codewords(classes: int, seed: int = 11) -> np.ndarray:
    """Rows of +-1, one a class, far apart: all splits of up to five classes,
    else the random code with the largest least distance of fifty."""
    if classes == 1:
        return np.ones((1, 1))
    if classes <= 5:
        return np.array([(1, *bits) for bits in itertools.product((1, -1), repeat=classes - 1) if -1 in bits]).T.astype(float)
    random = np.random.default_rng(seed)
    best, far = None, -1
    for _ in range(50):
        code = np.where(random.random((classes, max(15, int(10 * np.log2(classes))))) < 0.5, 1.0, -1.0)
        code = code[:, np.abs(code.sum(0)) < classes]
        gap = min(np.sum(a != b) for a, b in itertools.combinations(code, 2))
        if gap > far:
            best, far = code, gap
    return best


def features(text: str, letters: np.ndarray) -> np.ndarray:
    """Counts of hashed byte n-grams of the lower-case text, of length 1."""
    raw = letters[np.frombuffer(f" {text.lower()} ".encode(), dtype=np.uint8)]
    out = np.zeros(FEATURES, dtype=np.float32)
    gram = np.zeros(len(raw), dtype=np.uint32)
    for n in range(1, max(GRAMS) + 1):
        gram = gram[: len(raw) - n + 1] * np.uint32(257) + raw[n - 1:]
        if n in GRAMS:
            slots = (gram * np.uint32(0x9E3779B1) + np.uint32(n * 0x85EBCA77 & 0xFFFFFFFF)) >> np.uint32(32 - 13)
            out += np.bincount(slots, minlength=FEATURES)
    return out / np.sqrt(np.dot(out, out))


def letter_table() -> np.ndarray:
    """Bytes with all ASCII but letters as a space."""
    table = np.arange(256, dtype=np.uint32)
    table[[c for c in range(128) if not chr(c).isalpha()]] = 32
    return table


class Model:
    """Fitted on (text, language) pairs; ``decide`` gives language, score, ambiguity."""

    def __init__(self, pairs: list[tuple[str, str]]):
        self.languages = sorted({lang for _, lang in pairs})
        self.letters = letter_table()
        if not self.languages:
            return
        self.code = codewords(len(self.languages))
        target = np.array([self.languages.index(lang) for _, lang in pairs])
        x = np.stack([features(text, self.letters) for text, _ in pairs])
        y = self.code[target]
        share = 1 / np.bincount(target)[target]
        share = (share / share.sum())[:, None]  # languages weigh the same
        self.weights, self.bias = np.zeros((FEATURES, y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
        moved = [np.zeros_like(self.weights), np.zeros_like(self.bias)]
        for _ in range(STEPS):  # gradient descent with momentum on the logistic loss
            error = (-y * share / (1 + np.exp(np.clip(y * (x @ self.weights + self.bias), -30, 30)))).astype(np.float32)
            moved[0] = 0.9 * moved[0] - 8 * (x.T @ error + 1e-5 * self.weights)
            moved[1] = 0.9 * moved[1] - 8 * error.sum(0)
            self.weights += moved[0]
            self.bias += moved[1]
        right = (y * (x @ self.weights + self.bias) > 0).astype(float)
        trust = np.stack([right[target == k].mean(0) for k in range(len(self.languages))]) + 1e-3
        self.trust = trust / trust.sum(1, keepdims=True)

    def decide(self, text: str | None) -> tuple[str, float, bool]:
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        margins = features(text, self.letters) @ self.weights + self.bias
        loss = (self.trust * np.logaddexp(0, -self.code * margins)).sum(1)
        if len(loss) == 1:
            return self.languages[0], 1.0, False
        order = np.argsort(loss, kind="stable")
        odds = np.exp(-(loss - loss[order[0]]) * self.code.shape[1])
        share = float(1 / (1 + odds[order[1]]))
        return self.languages[order[0]], float(1 / odds.sum()), share < LEAST_SCORE


def held_out() -> Column:
    """Rows kept apart: crc32 of the id's text leaves a remainder of 2. A null id isn't."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame, per_language: int = SAMPLE_ROWS) -> Model:
    """Learn from rows that aren't held out and have text and language. Rows
    are drawn by a hash, about ``per_language`` of each language."""
    rows = docs.select("doc_id", "text", "lang").where(~held_out() & F.col("text").isNotNull() & F.col("lang").isNotNull())
    counts = rows.groupBy("lang").count().collect()  # a row a language
    if not counts:
        return Model([])
    share = F.create_map(*[F.lit(v) for lang, n in counts for v in (lang, min(1.0, per_language / n))])
    drawn = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30))
    pairs = sorted({(text, lang) for _, text, lang in drawn.collect()})
    return Model([p for p in pairs if any(map(str.isalpha, p[0]))])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred, score, ambiguous, letters``, from the text alone.

    Null text and text without a letter are ``und`` with score 0, ambiguous.
    All other columns stay, but those with these names are replaced. Whole
    texts are used. Without anything learned all is ``und``.
    """
    added = T.StructType([
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("ambiguous", T.BooleanType()), T.StructField("letters", T.LongType())])
    kept = [c for c in docs.columns if c not in added.names]
    schema = T.StructType([docs.schema[c] for c in kept] + added.fields)

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole)):
            texts = batch.column("text").to_pylist()
            decided = [model.decide(t) for t in texts]
            letters = [sum(map(str.isalpha, t)) if t and a else 0 for t, (_, _, a) in zip(texts, decided)]
            columns = [pa.array(c, kind) for c, kind in zip([*zip(*decided), letters], (pa.string(), pa.float64(), pa.bool_(), pa.int64()))] \
                if texts else [pa.array([], kind) for kind in (pa.string(), pa.float64(), pa.bool_(), pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=schema.names)

    return docs.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(released(run), schema)


def accepted(identified: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a language: no ``und``, and ambiguous only where the text is short."""
    return identified.where((F.col("lang_pred") != UNKNOWN) & ~(F.col("ambiguous") & (F.col("letters") >= REJECT_LETTERS))).select(*columns)


def drop_rejected(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows that have no language, see ``accepted``.

    Columns stay as they are, also those named like the ones ``identify`` adds.
    Null and empty texts and those without a letter go; repeated rows stay or go
    together; an empty table stays empty.
    """
    names = {c: c if c == "text" else f"_{at}" for at, c in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(f"`{c}`").alias(name) for c, name in names.items()])
    kept = accepted(identify(renamed, model), list(names.values()))
    return kept.select(*[F.col(name).alias(c) for c, name in names.items()])
