"""Cleaning facts: types, contradictions, wrongly scaled and huge values."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.scalars import nan_to_null, value_adj
from ..schemas import KEY, POLICY, require_columns
from .checkpoints import cut

_log = logging.getLogger(__name__)


def normalize_fact_types(facts: DataFrame) -> DataFrame:
    """adsh must be a number; a value that is none becomes null, and so does NaN."""
    require_columns(facts, [*KEY, "value"], "facts")
    value = F.col("value").cast("double") if isinstance(facts.schema["value"].dataType, NumericType) else F.col("value").cast("string").try_cast("double")
    return facts.withColumns({"adsh": F.col("adsh").cast("long"), "value": nan_to_null(value), "start": F.col("start").cast("date"), "end": F.col("end").cast("date")})


def drop_contradictions(facts: DataFrame) -> DataFrame:
    """One copy of identical rows; no row of a key that has several values. One aggregation, no second pass."""
    rest = [c for c in facts.columns if c not in (*KEY, "value")]
    grouped = facts.groupBy(*KEY).agg(F.min("value").alias("value"), F.max("value").alias("__max"), F.count("value").alias("__n"), F.count("*").alias("__all"), *[F.first(c).alias(c) for c in rest])
    same = F.col("value").eqNullSafe(F.col("__max")) & ((F.col("__n") == F.col("__all")) | (F.col("__n") == 0))
    return grouped.where(same).select(*facts.columns)


def remove_huge_values(facts: DataFrame) -> DataFrame:
    """|value| up to 5e12, or a tag that may be larger; a null value needs such a tag."""
    return facts.where(F.coalesce(F.abs("value") <= POLICY.max_abs_value, F.lit(False)) | F.col("tag").isin(*POLICY.large_value_tags))


def split_instant_duration(facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    return facts.where("start = end"), facts.where("start <> end")


def attach_cik(facts: DataFrame, sub: DataFrame) -> DataFrame:
    """Facts of known filings with their company; every filing has one row, its highest cik."""
    return facts.join(sub.groupBy("adsh").agg(F.max("cik").alias("cik")), "adsh")


def median_by_tag(facts: DataFrame) -> DataFrame:
    """Exact median of value_adj per (cik, tag)."""
    return facts.groupBy("cik", "tag").agg(F.median("value_adj").alias("median"))


def _scaled(v: Column, m: Column, y: Column) -> Column:
    """The multiplier of a value (magnitudes: value, median, neighbour); fixed thresholds, first class that applies."""
    k = (v > m * 100) & (((v > y * 965) & (v < y * 1036)) | ((v > y * 950) & (v < y * 1053) & (v > 3.2e8)) | ((v > y * 750) & (v < y * 1333) & (v > 63e9)))
    mil = (v > m * 10000) & (v > y * 750000) & (v < y * 1333000)
    per_k = (v < m / 100) & (((v > y / 1036) & (v < y / 965)) | ((v > y / 1053) & (v < y / 950) & (y > 3.2e8)) | ((v > y / 1333) & (v < y / 750) & (y > 63e9)))
    per_mil = (v < m / 10000) & (v > y / 1333000) & (v < y / 750000)
    return F.when(k & ~mil, 1).when(mil, 2).when(per_k & ~per_mil, 3).when(per_mil, 4)


def outlier_pairs(facts: DataFrame) -> DataFrame:
    """Rows far from the median of their (cik, tag), each with the rows that end within 120 days of it.

    The median test comes first, so only suspects are joined; the range join runs on buckets of 120 days.
    """
    days = F.datediff("end", F.lit("1970-01-01").cast("date"))
    width = POLICY.outlier_neighbour_days
    rows = facts.join(median_by_tag(facts), ["cik", "tag"])
    v, m = F.abs("value"), F.abs("median")
    suspects = rows.where((v != 0) & ((v > m * 100) | (v < m / 100))).withColumn("bucket", F.explode(F.sequence(F.floor(days / width) - 1, F.floor(days / width) + 1)))
    near = facts.select("cik", "tag", F.floor(days / width).alias("bucket"), F.col("end").alias("end_y"), F.col("value_adj").alias("y"))
    return suspects.join(near, ["cik", "tag", "bucket"]).where(F.abs(F.datediff("end_y", "end")) <= width)


class Corrections(int):
    """The number of corrected values; `rounds` is how many rounds found some, and `settled` whether the last round that was allowed found none."""

    rounds: int
    settled: bool

    @classmethod
    def of(cls, n: int, rounds: int, settled: bool) -> Corrections:
        out = cls(n)
        out.rounds, out.settled = rounds, settled
        return out


def correct_scale_outliers(facts: DataFrame, sub: DataFrame) -> tuple[DataFrame, Corrections]:
    """Facts with values that are off by a factor of 1e3 or 1e6 set right, and the number of corrections.

    Repeats until nothing is found, POLICY.max_outlier_rounds times at most; if values are still out of scale after that, the corrections
    are not `settled`. Only (cik, tag) groups with a correction go into the next round. Facts must be unique by (adsh, tag, start, end), as
    drop_contradictions leaves them. Corrections are counted while they are written, without a job of their own.
    """
    columns = facts.columns
    rows = cut(attach_cik(facts, sub).withColumn("value_adj", value_adj(F.col("start"), F.col("end"), F.col("value"))))
    done, total, found = None, 0, 0
    while True:
        hit = outlier_pairs(rows).withColumn("c", _scaled(F.abs("value"), F.abs("median"), F.abs("y"))).where("c is not null")
        hit = hit.groupBy(*KEY, "cik").agg(F.element_at(F.array(*[F.lit(x) for x in (1e-3, 1e-6, 1e3, 1e6)]), F.min("c")).alias("mult"))
        count_corrections = Observation()
        hit = cut(hit.observe(count_corrections, F.count("*").alias("n")))
        n = count_corrections.get["n"]
        if not n or found == POLICY.max_outlier_rounds:
            break
        total, found = total + n, found + 1
        groups = hit.select("cik", "tag").distinct()
        settled = rows.join(groups, ["cik", "tag"], "left_anti").select(*columns)
        done = settled if done is None else done.unionByName(settled)
        mult = F.coalesce("mult", F.lit(1.0))
        rows = rows.join(groups, ["cik", "tag"], "left_semi").join(hit, [*KEY, "cik"], "left")
        rows = cut(rows.withColumns({"value": F.col("value") * mult, "value_adj": F.col("value_adj") * mult}).select(*columns, "cik", "value_adj"))
    if n:
        _log.warning("%d values are out of scale after %d rounds", n, found)
    last = rows.select(*columns)
    return (last if done is None else done.unionByName(last)), Corrections.of(total, found, not n)
