"""The corpus pipeline: from documents to packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written and read again as the next one's ``docs``. All but the last return the
columns of ``documents`` with their values, whatever they are called. An empty
table passes through all stages; whole texts are used, however long.
"""

from pyspark.sql import DataFrame, SparkSession

from drivesync.llm import decontam, langid, linededup, neardup, packing
from drivesync.llm.common import stored
from drivesync.llm.queries import documents, tokenizer_path

# Words a worker of ``pack`` remembers: fewer than on its own, since executors that
# ran the stages before have little memory left. More words only save time.
REMEMBERED_WORDS = 150_000


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: those without a letter or text go, and those
    between languages that are long enough to tell. Null and empty texts go, too;
    repeated rows stay or go together."""
    return langid.drop_rejected(docs, langid.fit(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source are cut out of its documents. All rows stay;
    those without a source are one source; null text stays null, and a document
    all of whose lines are boilerplate stays as it is."""
    return linededup.drop_boilerplate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of near duplicates stays.
    Of rows equal in id and text one stays; rows without an id, and those whose
    text is null or has no words, are in no group."""
    return neardup.drop_near_duplicates(docs, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go. Null and empty texts hold none, and
    rows without an id are judged by their text like all others."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences: a row a piece, as in ``op1_packing``.
    Null and empty texts are one token, the end of the document; repeated rows are
    packed each."""
    return packing.pack_documents(docs, tokenizer_path(), remember=REMEMBERED_WORDS)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

# Classifiers, components and packing have no SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
