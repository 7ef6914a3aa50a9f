"""Helpers that the operators of this package share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The split of labelled rows and of language-model documents is fixed by this checksum.
FOLDS = 5


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of this machine where that is unset and no other takes part."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not f"{spark.sparkContext.master}[".startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not getattr(shared_dir, "own", None):
        shared_dir.own = "file://" + tempfile.mkdtemp(prefix="spark-")
    return shared_dir.own


_paths: list[str] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_so_far() -> int:
    """How many tables `written` has made and nobody has cleared."""
    return len(_paths)


def clear_written(spark: SparkSession, *, since: int = 0, but_last: bool = False) -> int:
    """Deletes the tables that `written` has made in this process (after the first `since`; all but the last one), and returns their number.

    Results that rest on them must have been stored before.
    """
    jvm, gone = spark.sparkContext._jvm, _paths[since : -1 if but_last else None]
    _paths[since:] = _paths[-1:] if but_last and len(_paths) > since else []
    for name in gone:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return len(gone)


def shuffle_parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def utf8(batch: pa.RecordBatch, i: int) -> list[bytes]:
    """Column i as bytes; null is the empty text."""
    return [x or b"" for x in batch.column(i).cast(pa.large_binary()).to_pylist()]


class Index(dict):
    """Numbers words in order of first sight."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def numbered(words: list[bytes], index: Index) -> np.ndarray:
    return np.fromiter(map(index.__getitem__, words), np.int64, len(words))


def hash64(words) -> np.ndarray:
    """A stable 64-bit hash of each word."""
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(map(digest, words), np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit integers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordHashes(dict):
    """word -> 64-bit hash, remembered up to a bound so that a worker's memory stays small."""

    LIMIT = 300_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def batches(rows: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most `most`."""
    for batch in rows:
        for at in range(0, batch.num_rows, most):
            yield batch.slice(at, most)
