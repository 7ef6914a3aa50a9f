"""The driver's star-schema tables as filings, facts and equations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.submissions import amendment_flags


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as filings of customers: (adsh, cik, form, period, accepted, version), with amendment flags."""
    form = F.when(F.col("o_orderpriority") == "1-URGENT", "10-K").when(F.col("o_orderpriority") == "2-HIGH", "10-K/A").otherwise("10-Q")
    version = F.when(F.col("o_orderkey") % 5 == 0, 0).otherwise(F.year("o_orderdate")).cast("int")
    rows = table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 1).alias("adsh"), F.col("o_custkey").alias("cik"), form.alias("form"), F.last_day(F.to_date("o_orderdate")).alias("period"), F.col("o_orderdate").alias("accepted"), version.alias("version"))
    return amendment_flags(rows)


def facts(spark: SparkSession, sf_dir: str, *, tag: str = "p_type") -> DataFrame:
    """Line items as facts of their order's filing: (adsh, tag, start, end, value)."""
    line = F.col("l_linenumber") % 5
    last = F.last_day(F.to_date("o_orderdate"))
    start = (
        F.when(line == 1, F.trunc("o_orderdate", "year")).when(line == 2, F.trunc("o_orderdate", "quarter"))
        .when(line == 3, F.add_months(F.trunc("o_orderdate", "year"), -12)).when(line == 4, F.add_months(F.trunc("o_orderdate", "quarter"), -12)).otherwise(last)
    )
    end = F.when(line.isin(3, 4), F.date_sub(last, 0) - F.expr("interval 1 year")).otherwise(last).cast("date")
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.select((F.col("l_orderkey") + 1).alias("adsh"), F.col(tag).cast("string").alias("tag"), start.alias("start"), end.alias("end"), F.col("l_extendedprice").alias("value"))


def sub_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filings with windows: from the start of the period's year to the period."""
    return submissions(spark, sf_dir).withColumns({"start_rep": F.trunc("period", "year"), "end_rep": F.col("period")})


def link_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One figure per filing and part type: the sum of prices; py columns where the line's number is even. Dealt by filing, as the links are that figures meet next."""
    price = F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double")
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.select((F.col("l_orderkey") + 1).alias("adsh"), F.col("p_type").alias("tag"), "l_extendedprice", "l_linenumber").repartition("adsh")
    out = rows.groupBy("adsh", "tag").agg(price.alias("reported_figure"), F.max(F.col("l_linenumber")).alias("k"))
    odd = lambda m: F.when(F.col("k") % m == 0, F.col("reported_figure"))
    return out.select("adsh", "tag", "reported_figure", odd(3).alias("quarterly_figure"), odd(2).alias("reported_figure_py"), odd(4).alias("quarterly_figure_py"), F.lit(False).alias("is_computed"), (F.col("k") == 7).alias("is_instant"))


#: Shares of an order's price that stand for component tags, and the equations between them.
COMPONENTS = {"X": 1.0, "Y": 2.0, "Z": 4.0}
ARC_ROWS = ((1, "soi", 0, "XY", "X", 1.0), (1, "soi", 0, "XY", "Y", 1.0), (1, "soi", 1, "ALL", "XY", 1.0), (1, "soi", 1, "ALL", "Z", 1.0), (1, "sfp", 0, "GAP", "Z", 1.0), (1, "sfp", 0, "GAP", "X", -1.0))


def arc_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags X, Y, Z of each filing as multiples of its price in cents, XY for 3 filings in 4 (right), GAP for all (wrong for 1 in 4)."""
    cents = F.round(F.col("o_totalprice") * 100).cast("long").cast("double")
    key = F.col("o_orderkey") + 1
    kinds = [(t, cents * k) for t, k in COMPONENTS.items()] + [("XY", F.when(key % 4 != 0, cents * 3)), ("GAP", cents * F.when(key % 4 == 1, 5.0).otherwise(3.0))]
    rows = table(spark, sf_dir, "orders").select(key.alias("adsh"), F.explode(F.array(*[F.struct(F.lit(t).alias("tag"), v.alias("reported_figure")) for t, v in kinds])).alias("f"))
    return rows.select("adsh", "f.tag", "f.reported_figure", F.col("f.reported_figure").alias("quarterly_figure"), F.lit(None).cast("double").alias("reported_figure_py"), F.lit(None).cast("double").alias("quarterly_figure_py"), F.lit(False).alias("is_computed"), F.lit(False).alias("is_instant")).where("reported_figure is not null")


def arcs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(ARC_ROWS), "version int, statement string, seq int, `from` string, `to` string, weight double")


def arc_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 1).alias("adsh"), F.lit(1).alias("version"))
