"""Filing metadata: source precedence, amendment flags, taxonomy version repair."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import POLICY, require_columns


def filter_forms(sub: DataFrame) -> DataFrame:
    return sub.where(F.col("form").isin(*POLICY.forms))


def amendment_flags(sub: DataFrame) -> DataFrame:
    """amendment_adsh: the last filing of the same company and period, 0 on that filing itself; is_amended accordingly.

    Filings of one period count whatever their form. Ties in acceptance go to the larger adsh.
    """
    require_columns(sub, ["adsh", "cik", "period", "accepted"], "submissions")
    whole = Window.partitionBy("cik", "period").orderBy("accepted", "adsh").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = F.last("adsh").over(whole)
    out = sub.withColumn("amendment_adsh", F.when(last != F.col("adsh"), last).otherwise(F.lit(0)).cast("long"))
    return out.withColumn("is_amended", F.col("amendment_adsh") != 0)


def repair_version(sub: DataFrame) -> DataFrame:
    """Version 0 takes the version of the filing that it amends, else the last known before it, else the next after it, per company.

    Of several filings amended by one, the latest accepted gives its version. A company without any version keeps 0.
    """
    require_columns(sub, ["adsh", "cik", "accepted", "version", "amendment_adsh"], "submissions")
    source = sub.where("amendment_adsh <> 0").groupBy(F.col("amendment_adsh").alias("adsh")).agg(F.max_by("version", F.struct("accepted", "adsh")).alias("__from"))
    known = F.nullif(F.col("version"), F.lit(0))
    rows = sub.join(source, "adsh", "left").withColumn("__v", F.coalesce(known, F.nullif(F.col("__from"), F.lit(0))))
    order = Window.partitionBy("cik").orderBy("accepted", "adsh")
    back = F.last("__v", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ahead = F.first("__v", ignorenulls=True).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    return rows.withColumn("version", F.coalesce(back, ahead, F.lit(0)).cast("int")).select(*sub.columns)


def one_row_per_filing(sub: DataFrame) -> DataFrame:
    """One row per adsh, the one with the highest version, if there is one (then the first in the order of all columns)."""
    order = Window.partitionBy("adsh").orderBy(*[F.col(c).desc_nulls_last() for c in ("version",) if c in sub.columns], *[F.col(c) for c in sub.columns if c not in ("adsh", "version")])
    return sub.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def attach_tickers(sub: DataFrame, tickers: DataFrame) -> DataFrame:
    return sub.join(tickers.select("cik", "ticker"), "cik")


def semi_known(sub: DataFrame, facts: DataFrame) -> DataFrame:
    """Filings that have facts."""
    return sub.join(facts.select("adsh").distinct(), "adsh", "left_semi")


def anti_versioned(sub: DataFrame, versioned: DataFrame) -> DataFrame:
    """Filings that no versioned source has."""
    return sub.join(versioned.select("adsh"), "adsh", "left_anti")


def reports_without_facts(sub: DataFrame, facts: DataFrame) -> DataFrame:
    return sub.join(facts.select("adsh").distinct(), "adsh", "left_anti")


def missing_adsh(facts: DataFrame, *sources: DataFrame) -> DataFrame:
    """Filings with facts that no metadata source knows."""
    out = facts.select("adsh").distinct()
    for s in sources:
        out = out.join(s.select("adsh"), "adsh", "left_anti")
    return out


def combine_submission_sources(quarterly: DataFrame, bulk: DataFrame, looked_up: DataFrame, facts: DataFrame, tickers: DataFrame, documents: DataFrame) -> DataFrame:
    """Metadata in order of precedence: quarterly rows with a version, bulk rows, looked-up rows, the latter two if they have facts; flagged and with tickers.

    The version of bulk and looked-up rows is scanned from their primary document (documents: adsh, text).
    """
    from ..sources.landed import scan_taxonomy_version

    versioned = one_row_per_filing(quarterly.where("version <> 0"))
    rest = semi_known(anti_versioned(one_row_per_filing(bulk.withColumn("version", F.lit(0))), versioned), facts)
    extra = semi_known(anti_versioned(one_row_per_filing(looked_up.withColumn("version", F.lit(0))), versioned.select("adsh").union(rest.select("adsh"))), facts)
    scanned = scan_taxonomy_version(rest.unionByName(extra, allowMissingColumns=True), documents)
    both = filter_forms(versioned.unionByName(scanned, allowMissingColumns=True))
    out = attach_tickers(amendment_flags(both), tickers)
    return out.select("adsh", "cik", F.coalesce("sic", F.lit(0)).cast("long").alias("sic"), "form", "period", "accepted", F.col("version").cast("int").alias("version"), "amendment_adsh", "is_amended", "ticker")
