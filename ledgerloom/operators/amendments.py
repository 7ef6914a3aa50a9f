"""Amended filings: canonical ids and carrying over what an amendment leaves out."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import KEY, require_columns
from .checkpoints import cut

_log = logging.getLogger(__name__)


def _jumped(ptr: DataFrame, rounds: int) -> DataFrame:
    """Pointers (adsh, to, low) after jumping until nothing moves, or for a number of rounds; low: the smallest id passed."""
    for _ in range(rounds):
        following = ptr.select(F.col("adsh").alias("__at"), F.col("to").alias("__next"), F.col("low").alias("__low"))
        ptr = cut(ptr.join(following, F.col("to") == F.col("__at"), "left").select("adsh", F.coalesce("__next", "to").alias("to"), F.least("low", F.coalesce("__low", "low")).alias("low"), (F.coalesce("__next", "to") != F.col("to")).alias("moved")))
        if ptr.where("moved").isEmpty():
            break
    return ptr.drop("moved")


def canonical_adsh_map(sub: DataFrame) -> DataFrame:
    """(adsh_original, adsh_canonical): A -> B -> C resolves to C, however long the chain.

    Pointer jumping: every round doubles the distance covered, so after as many rounds as the number of filings has binary digits
    only pointers into a circle still move. Those are logged and resolve to the smallest id of their circle (circular_amendments names them).
    """
    require_columns(sub, ["adsh", "amendment_adsh"], "submissions")
    ptr = sub.groupBy("adsh").agg(F.max(F.coalesce("amendment_adsh", F.lit(0))).alias("to"))
    ptr = cut(ptr.select("adsh", F.when(F.col("to") == 0, F.col("adsh")).otherwise(F.col("to")).alias("to"), F.col("adsh").alias("low")))
    out = _jumped(ptr, ptr.count().bit_length() + 1)
    # whoever has not arrived at a filing that amends nothing is in a circle or on the way to one, and has arrived there
    amends = ptr.where("`to` <> adsh").select(F.col("adsh").alias("__x")).join(out.select(F.col("adsh").alias("__x"), F.col("low").alias("__low")), "__x")
    circles = cut(out.select(F.col("to").alias("__x")).distinct().join(amends, "__x"))
    if circles.isEmpty():
        return out.select(F.col("adsh").alias("adsh_original"), F.col("to").alias("adsh_canonical"))
    _log.warning("amendments go in a circle")
    return out.join(circles, F.col("to") == F.col("__x"), "left").select(F.col("adsh").alias("adsh_original"), F.coalesce("__low", "to").alias("adsh_canonical"))


def circular_amendments(sub: DataFrame) -> DataFrame:
    """(adsh) of the filings that amend each other in a circle: what is left when filings that nothing left points to, or that point to nothing left, go again and again."""
    edges = sub.where(F.coalesce("amendment_adsh", F.lit(0)) != 0).groupBy("adsh").agg(F.max("amendment_adsh").alias("to")).where("adsh <> `to`")
    left, n = cut(edges), None
    while n != (now := left.count()):
        n = now
        left = cut(left.join(left.select(F.col("adsh").alias("to")), "to", "left_semi").join(left.select(F.col("to").alias("adsh")).distinct(), "adsh", "left_semi").select("adsh", "to"))
    return left.select("adsh")


def apply_canonical_adsh(facts: DataFrame, mapping: DataFrame) -> DataFrame:
    """Facts under their canonical filing; unknown filings keep their own id."""
    m = mapping.select(F.col("adsh_original").alias("__o"), F.col("adsh_canonical").alias("__c"))
    return facts.join(m, F.col("adsh") == F.col("__o"), "left").withColumn("adsh", F.coalesce("__c", "adsh")).select(*facts.columns)


def accepted_by_canonical(sub: DataFrame, mapping: DataFrame) -> DataFrame:
    m = mapping.select(F.col("adsh_original").alias("adsh"), "adsh_canonical")
    return sub.select("adsh", "accepted").join(m, "adsh", "left").groupBy(F.coalesce("adsh_canonical", "adsh").alias("adsh")).agg(F.max("accepted").alias("accepted"))


def dedupe_latest_by_acceptance(facts: DataFrame, sub: DataFrame, *, source_col: str | None = None) -> DataFrame:
    """One row per (adsh, tag, start, end): the one whose source filing was accepted last, then the smallest value."""
    require_columns(facts, [*KEY, "value"], "facts")
    if source_col:
        rows = facts.join(sub.groupBy(F.col("adsh").alias("__s")).agg(F.max("accepted").alias("__accepted")), F.col(source_col) == F.col("__s"), "left")
    else:
        rows = facts.withColumn("__accepted", F.lit(None).cast("timestamp_ntz"))
    order = Window.partitionBy(*KEY).orderBy(F.col("__accepted").desc_nulls_last(), F.col("value").asc_nulls_last())
    return rows.withColumn("__n", F.row_number().over(order)).where("__n = 1").select(*facts.columns)


def merge_amendments(facts: DataFrame, sub: DataFrame) -> DataFrame:
    """Copy to every amended filing the fact keys (tag, start, end) that it lacks from the filings it amends.

    The filing's own rows win, then the earliest accepted source; all rows of the winning source with that key are
    copied. Originals are kept and exact duplicates dropped. Chains of any length are worked off from their far end,
    one level a round; flags made by amendment_flags are stars and take one round. Cycles, and what they lead to, are
    gone round until nothing is lacking.
    """
    require_columns(facts, [*KEY, "value"], "facts")
    require_columns(sub, ["adsh", "amendment_adsh", "accepted"], "submissions")
    edges = sub.where(F.coalesce("amendment_adsh", F.lit(0)) != 0).groupBy(F.col("adsh").alias("source"), F.col("amendment_adsh").alias("target")).agg(F.max("accepted").alias("at"))
    # a round takes the edges into whose source no other edge is left; in the end only cycles and what they lead to are left
    left, steps = cut(edges), []
    n_left = left.count()
    while n_left:
        into = left.select(F.col("target").alias("source")).distinct()
        rest = cut(left.join(into, "source", "left_semi"))
        n_rest = rest.count()
        if n_rest == n_left:
            break
        steps.append(left.join(into, "source", "left_anti").select("source", "target", "at"))
        left, n_left = rest, n_rest
    out, columns = facts, facts.columns

    def copied(step: DataFrame) -> DataFrame:
        given = out.join(step, out["adsh"] == step["source"]).drop("adsh").withColumnRenamed("target", "adsh")
        lacking = given.join(out.select(*KEY).distinct(), list(KEY), "left_anti")
        first = Window.partitionBy(*KEY).orderBy("at", "source")
        return lacking.withColumn("__rank", F.rank().over(first)).where("__rank = 1").select(*columns)

    for step in steps:
        out = out.unionByName(copied(step))
        if len(steps) > 1 or n_left:
            out = cut(out)
    while n_left:
        more = cut(copied(left))
        if more.isEmpty():
            break
        out = cut(out.unionByName(more))
    # by filing, so that what follows by filing and tag needs no other shuffle
    return out.repartition("adsh").dropDuplicates([*KEY, "value"])
