"""From raw documents to a training mix in five stages.

Each stage takes all rows that the stage before it kept and, but for the last, returns the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import decontaminate, mixing, near_dup, rule_quality, secrets
from ledgerloom.llm._base import clear_written, table, written, written_so_far

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document goes if a benchmark item is in it with at least this share of the item's tokens, or side by side for this many, of which a few may differ.
ITEM_SHARE, OVERLAP_TOKENS = 0.5, 13
#: Rows up to this number are broadcast by their keys (16 MB); more are joined by shuffling.
BROADCAST_ROWS = 1_000_000


def _key() -> Column:
    """Names a row by its id and text, so that rows that share an id are judged apart."""
    return F.xxhash64("doc_id", "text", F.col("doc_id").isNull(), F.col("text").isNull())


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows whose keys are not in `gone` (key)."""
    gone = written(gone.distinct(), "gone")
    return docs.withColumn("key", _key()).join(F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone, "key", "left_anti").select(*COLUMNS)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what the rule ensemble doesn't reject.

    The verdict rests on the text alone, so rows of one id are told apart and repeated rows fare alike; null and empty
    texts are judged as texts without words. An empty table gives an empty one. Labels of one kind only keep or reject all.
    """
    docs = docs.select(*COLUMNS)
    statistics = rule_quality.text_statistics(docs, keep=COLUMNS[1:])
    score = rule_quality.learn(docs, table(spark, sf_dir, "labels")).column()
    return statistics.where(score >= rule_quality.THRESHOLD).select(*COLUMNS)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id.

    Documents without words are no copies of each other and stay. A row without an id goes if its group has an id, and
    stays otherwise. Of repeated rows one stays; rows that share an id but are no copies all stay. Ties play no part.
    """
    docs = docs.select(*COLUMNS)
    found = near_dup.near_duplicates(docs.withColumn("key", _key()), keep=("key",))
    once = _without(docs, found.where("not kept").select("key"))
    twice = written(once.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 and doc_id is not null").select("doc_id"), "twice")
    if twice.isEmpty():
        return once
    small = F.broadcast(twice) if twice.count() <= BROADCAST_ROWS else twice
    return once.join(small, "doc_id", "left_anti").select(*COLUMNS).unionByName(once.join(small, "doc_id", "left_semi").select(*COLUMNS).dropDuplicates(["doc_id", "text"]))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item.

    Each row is judged by its own text, whatever its id; null and empty texts stay, and repeated rows fare alike. Without
    benchmark items every row stays.
    """
    docs = docs.select(*COLUMNS)
    met = decontaminate.contaminated(docs.select(_key().alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return _without(docs, met.where((F.col("item_share") >= ITEM_SHARE) | (F.col("n_overlap") >= OVERLAP_TOKENS)).select(F.col("doc_id").alias("key")))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes live-looking credentials out of the texts; widely copied examples stay, and so does every document.

    Null texts stay null, and repeated rows are all masked.
    """
    return secrets.redact(docs.select(*COLUMNS)).select(*COLUMNS)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, each with how often.

    Documents without words, null texts among them, come along in the whole repetitions of their source; a null source
    is a source of its own; each of several equal rows is mixed by itself.
    """
    mixed = mixing.mix_sources(docs, keep=("text", "lang", "n_chars"))
    return mixed.where("repeats > 0").select(*COLUMNS, "size", "source_size", "target", "repeats", "taken")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("source_mixing", source_mixing),
]

#: Trees, minhashes and spaced seeds are beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What a stage has written for itself, and its input, goes once its own result is written."""
    docs, before = table(spark, sf_dir, "documents"), written_so_far()
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
        clear_written(spark, since=before, but_last=True)
    return STAGES[-1][1](spark, docs, sf_dir)
