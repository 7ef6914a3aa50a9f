"""Cutting the lineage of loops in a way that survives lost executors."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in spark.checkpoint.dir; a folder of this machine only where that is unset and no other takes part."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(named or "file://" + tempfile.mkdtemp(prefix="spark-"))
    return df.checkpoint()


@contextmanager
def unlimited_recursion(spark: SparkSession) -> Iterator[None]:
    """Recursive queries that run inside have no limit of rows; a query must end by itself or by its limit of levels."""
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, before)
