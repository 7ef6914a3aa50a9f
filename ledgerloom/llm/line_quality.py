"""Quality rules with cross-document line frequency.

Lines are normalised (A-Z lower-cased, runs of white space become one space), hashed with their host, and
counted by the distinct documents of that host that hold them. Lines above the limit are taken out of a
document, and a document that keeps too few of its words without them is rejected.

Each row is a document; repeated rows are several documents. Null and empty texts have no lines and fail the
base rules; a null host is a host of its own. Ties play no part. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._base import Index, batches, numbered, utf8, written

#: A line in more documents of its host than the greater of MIN_DOCS and MAX_SHARE of them is boilerplate.
MIN_DOCS, MAX_SHARE = 20, 0.01
#: A document that keeps less than this share of its words is depleted.
MIN_KEPT_PERCENT = 30
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Common lines up to this number are broadcast (8 MB); more are joined by shuffling, where Spark splits hot ones.
BROADCAST_LINES = 1_000_000
_SPACE, _SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"

STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeated_words(texts: list[list[bytes]]) -> np.ndarray:
    """For each list of words: how many are in a 3-word window that the same text has twice or more."""
    n, index = len(texts), Index()
    if not n:
        return np.zeros(0, np.int64)
    ids = np.concatenate([numbered(w, index) for w in texts])
    owner = np.repeat(np.arange(n), [len(w) for w in texts])
    starts = np.flatnonzero(owner[:-2] == owner[2:])
    if not len(starts):
        return np.zeros(n, np.int64)
    v, first, second, third = len(index), ids[starts], ids[starts + 1], ids[starts + 2]
    if v**3 * n < 2**63:
        window = (first * v + second) * v + third
    else:
        _, two = np.unique(first * v + second, return_inverse=True)
        _, window = np.unique(two * v + third, return_inverse=True)
    _, which, counts = np.unique(window * n + owner[starts], return_inverse=True, return_counts=True)
    hit = starts[counts[which] > 1]
    covered = np.zeros(len(ids), bool)
    for k in range(3):
        covered[hit + k] = True
    return np.bincount(owner[covered], minlength=n)


def _measure(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (doc_id, host, text): the statistics, and of each distinct normalised line its hash, words, and how often it occurs."""
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    for batch in batches(rows, 400):
        texts = utf8(batch, 2)
        hosts = [b"\x00" if h is None else b"=" + h for h in batch.column(1).cast(pa.binary()).to_pylist()]
        words = [t.split() for t in texts]
        n_chars, n_symbols, dups, lines, sizes = [], [], [], [], []
        for text, host in zip(texts, hosts, strict=True):
            bare = text.translate(None, _SPACE)
            n_chars.append(len(bare.decode("utf-8", "replace")))
            n_symbols.append(len(bare) - len(bare.translate(None, _SYMBOLS)))
            seen, own, dup = set(), {}, 0
            seed = digest(host)
            for line in text.split(b"\n"):
                parts = line.split()
                if not parts:
                    continue
                dup += line in seen
                seen.add(line)
                h = digest(b" ".join(parts).lower(), seed)
                own[h] = own.get(h, 0) + len(parts)
            dups.append(dup)
            lines.append(np.fromiter(own.keys(), np.uint64, len(own)).view(np.int64))
            sizes.append(np.fromiter(own.values(), np.int64, len(own)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.string()), pa.array([len(w) for w in words], pa.int64()), pa.array(n_chars, pa.int64()), pa.array(n_symbols, pa.int64()), pa.array(dups, pa.int64()), pa.array(repeated_words(words), pa.int64()), pa.array(lines, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int64()))],
            names=["doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines", "line_words"],
        )


def line_frequency_filter(docs: DataFrame, *, host: str = "source", min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, min_kept_percent: int = MIN_KEPT_PERCENT) -> DataFrame:
    """doc_id, the statistics, base_failed, n_common_words (words in lines above the limit) and kept, for each row of docs (doc_id, text, host)."""
    rows = docs.select("doc_id", F.col(host).alias("host"), "text").mapInArrow(_measure, f"doc_id long, host string, {STATS}, lines array<long>, line_words array<long>")
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "lines")
    # the hash of a line is seeded with its host, so equal hashes are equal lines of one host
    each = rows.select("row", "host", F.explode(F.arrays_zip("lines", "line_words")).alias("l")).select("row", "host", F.col("l.lines").alias("line"), F.col("l.line_words").alias("words"))
    hosts = rows.groupBy("host").agg(F.greatest(F.lit(float(min_docs)), F.count("*") * max_share).alias("most"))
    counts = each.groupBy("line").agg(F.count("*").alias("n"), F.first("host").alias("host")).where(F.col("n") > min_docs)
    common = written(counts.join(hosts.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h"))).where("n > most").select("line"), "common")
    # a common line is in more than min_docs documents, so there are few; they are the hot keys of a shuffled join
    lost = each.join(F.broadcast(common) if common.count() <= BROADCAST_LINES else common, "line").groupBy("row").agg(F.sum("words").alias("n_common_words"))
    out = rows.drop("lines", "line_words", "host").join(lost, "row", "left").drop("row").withColumn("n_common_words", F.coalesce("n_common_words", F.lit(0)))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    depleted = 100 * (F.col("n_words") - F.col("n_common_words")) < min_kept_percent * F.col("n_words")
    return out.withColumn("base_failed", failed).withColumn("kept", ~(failed | depleted))
