"""Reporting windows of filings and the values in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import add_years
from ..schemas import POLICY, require_columns


def count_facts_per_end(facts: DataFrame) -> DataFrame:
    return facts.where(F.year("end") <= 2100).groupBy("adsh", "end").agg(F.count("*").alias("n"))


def count_facts_per_range(facts: DataFrame, ends: DataFrame) -> DataFrame:
    """Rows per (adsh, end, start) for one chosen end per filing."""
    return facts.join(ends.select("adsh", "end"), ["adsh", "end"], "left_semi").groupBy("adsh", "end", "start").agg(F.count("*").alias("n"))


def best_end_per_filing(facts: DataFrame, sub: DataFrame, *, years_back: int = 0) -> DataFrame:
    """(adsh, end): the most frequent end within 30 days of the period (of the period `years_back` years earlier).

    Ties go to the nearest end, then to the latest.
    """
    off = F.abs(F.datediff("period", add_years(F.col("end"), years_back)))
    rows = count_facts_per_end(facts).join(sub.select("adsh", "period").distinct(), "adsh").where(off < POLICY.period_tolerance_days)
    return rows.groupBy("adsh").agg(F.max_by("end", F.struct("n", -off, "end")).alias("end"))


def rank_ranges(facts: DataFrame, ends: DataFrame) -> DataFrame:
    """(adsh, start, end, enum) of the two most frequent ranges at the chosen end, enum 1 the earlier start.

    The second counts only with 0.3 of the rows of the first. Ties go to the earlier start.
    """
    ranges = count_facts_per_range(facts, ends).where((F.col("start") != F.col("end")) & (F.date_add(add_years(F.col("start"), 1), 10) > F.col("end")))
    by_n = Window.partitionBy("adsh").orderBy(F.col("n").desc(), "start")
    top = ranges.withColumns({"rank": F.row_number().over(by_n), "most": F.max("n").over(Window.partitionBy("adsh"))})
    kept = top.where((F.col("rank") == 1) | ((F.col("rank") == 2) & (F.col("n") >= POLICY.second_range_share * F.col("most"))))
    return kept.select("adsh", "start", "end", F.row_number().over(Window.partitionBy("adsh").orderBy("start")).cast("tinyint").alias("enum"))


def align_prior_year_ranges(facts: DataFrame, ends_py: DataFrame, ranges: DataFrame) -> DataFrame:
    """(adsh, start, end, enum): the prior-year range that starts within 10 days of the start of enum 1 or 2 a year earlier, as enum 3 or 4."""
    ref = ranges.select("adsh", F.col("start").alias("ref"), "enum")
    near = F.abs(F.datediff("start", add_years(F.col("ref"), -1))) < POLICY.prior_year_tolerance_days
    rows = count_facts_per_range(facts, ends_py).join(ref, "adsh").where(near)
    first = Window.partitionBy("adsh", "enum").orderBy(F.col("n").desc(), "start")
    return rows.withColumn("rank", F.row_number().over(first)).where("rank = 1").select("adsh", "start", "end", (F.col("enum") + 2).cast("tinyint").alias("enum"))


def infer_reporting_windows(facts: DataFrame, sub: DataFrame) -> DataFrame:
    """(adsh, start, end, enum): 1 reported or year to date, 2 quarter, 3 and 4 the same a year earlier.

    The rules of best_end_per_filing, rank_ranges and align_prior_year_ranges on one count of rows per range: the few
    ranges of a filing are gathered, and all else is done within the filing, without another look at the facts.
    A filing of several rows has the latest of its periods.
    """
    require_columns(facts, ["adsh", "start", "end"], "facts")
    require_columns(sub, ["adsh", "period"], "submissions")
    ranges = facts.groupBy("adsh", "start", "end").agg(F.count("*").alias("n")).groupBy("adsh").agg(F.collect_list(F.struct("start", "end", "n")).alias("r"))
    rows = ranges.join(sub.groupBy("adsh").agg(F.max("period").alias("period")), "adsh")
    ends = F.array_distinct(F.transform(F.filter("r", lambda x: F.year(x["end"]) <= 2100), lambda x: x["end"]))
    of_end = lambda e: F.aggregate(F.filter("r", lambda x: x["end"] == e), F.lit(0).cast("long"), lambda a, x: a + x["n"])
    rows = rows.withColumn("ends", F.transform(ends, lambda e: F.struct(e.alias("end"), of_end(e).alias("n"))))

    def best(years: int) -> Column:
        off = lambda x: F.abs(F.datediff("period", add_years(x["end"], years)))
        near = F.filter("ends", lambda x: off(x) < POLICY.period_tolerance_days)
        return F.array_max(F.transform(near, lambda x: F.struct(x["n"].alias("n"), (-off(x)).alias("off"), x["end"].alias("end"))))["end"]

    rows = rows.select("adsh", "r", best(0).alias("now"), best(1).alias("then"))
    long_enough = lambda x: (x["start"] != x["end"]) & (F.date_add(add_years(x["start"], 1), 10) > x["end"])
    ranked = F.array_sort(F.transform(F.filter("r", lambda x: (x["end"] == F.col("now")) & long_enough(x)), lambda x: F.struct((-x["n"]).alias("less"), x["start"].alias("start"))))
    rows = rows.withColumn("two", F.slice(ranked, 1, 2))
    enough = F.filter("two", lambda x: -x["less"] >= POLICY.second_range_share * -F.col("two")[0]["less"])
    rows = rows.withColumn("starts", F.array_sort(F.transform(enough, lambda x: x["start"])))
    before = F.filter("r", lambda x: x["end"] == F.col("then"))

    def prior(ref: Column) -> Column:
        near = F.filter(before, lambda x: F.abs(F.datediff(x["start"], add_years(ref, -1))) < POLICY.prior_year_tolerance_days)
        return F.array_min(F.transform(near, lambda x: F.struct((-x["n"]).alias("less"), x["start"].alias("start"))))["start"]

    window = lambda start, end, k: F.struct(start.alias("start"), end.alias("end"), k.cast("tinyint").alias("enum"))
    current = F.transform("starts", lambda s, i: window(s, F.col("now"), i + 1))
    earlier = F.filter(F.transform("starts", lambda s, i: window(prior(s), F.col("then"), i + 3)), lambda w: w["start"].isNotNull())
    return rows.select("adsh", F.inline(F.concat(current, earlier)))


def _by_enum(columns: dict[str, int], value: str) -> list:
    return [F.max(F.when(F.col("enum") == k, F.col(value))).alias(name) for name, k in columns.items()]


def enrich_sub_with_windows(sub: DataFrame, windows: DataFrame) -> DataFrame:
    """Submissions with start and end of rep, q, rep_py and q_py, in one join."""
    names = {1: "rep", 2: "q", 3: "rep_py", 4: "q_py"}
    wide = windows.groupBy("adsh").agg(*[x for k, n in names.items() for x in _by_enum({f"start_{n}": k}, "start") + _by_enum({f"end_{n}": k}, "end")])
    return sub.join(wide, "adsh", "left")


def facts_in_windows(facts: DataFrame, windows: DataFrame) -> DataFrame:
    return facts.join(windows.select("adsh", "start", "end", "enum"), ["adsh", "start", "end"])


def compute_period_values(facts: DataFrame, sub: DataFrame, windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(adsh, tag, value1..value4) of tags that have a fact in window 1, and the submissions with their windows."""
    require_columns(facts, ["adsh", "tag", "start", "end", "value"], "facts")
    both = {f"{c}{k}": (c, k) for k in (1, 2, 3, 4) for c in ("start", "end")}
    ends = windows.groupBy("adsh").agg(*[F.max(F.when(F.col("enum") == k, F.col(c))).alias(f"__{n}") for n, (c, k) in both.items()])
    inside = lambda k: (F.col("start") == F.col(f"__start{k}")) & (F.col("end") == F.col(f"__end{k}"))
    # one row of windows a filing: facts stay where their filing is
    wide = facts.join(ends, "adsh").groupBy("adsh", "tag").agg(F.count_if(inside(1)).alias("anchor"), *[F.max(F.when(inside(k), F.col("value"))).alias(f"value{k}") for k in (1, 2, 3, 4)])
    return wide.where("anchor > 0").drop("anchor"), enrich_sub_with_windows(sub, windows)


def dedupe_instants(facts: DataFrame) -> DataFrame:
    """One value per (adsh, tag, end), the largest."""
    return facts.groupBy("adsh", "tag", "end").agg(F.max("value").alias("value"))


def compute_instant_values(facts: DataFrame, windows: DataFrame) -> DataFrame:
    """(adsh, tag, value1..value4): the instant values at the ends of the windows; tags without any stay, all null."""
    require_columns(facts, ["adsh", "tag", "end", "value"], "facts")
    ends = windows.groupBy("adsh").agg(*_by_enum({f"end{k}": k for k in (1, 2, 3, 4)}, "end"))
    joined = dedupe_instants(facts).join(ends, "adsh", "left")
    return joined.groupBy("adsh", "tag").agg(*[F.max(F.when(F.col("end") == F.col(f"end{k}"), F.col("value"))).alias(f"value{k}") for k in (1, 2, 3, 4)])
