"""Integrity rules of the tables. Each check returns its failures as text; check_all raises with all of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import FACTS, POLICY, SUBMISSIONS


def _schema(df: DataFrame, ddl: str) -> list[str]:
    want = {f.name: f.dataType.simpleString() for f in df.sparkSession.createDataFrame([], ddl).schema.fields}
    have = dict(df.dtypes)
    return [f"columns differ: {sorted(set(want) ^ set(have))}"] * (set(want) != set(have)) + [f"{c} is {have[c]}, not {t}" for c, t in want.items() if c in have and have[c] != t]


def submission_violations(sub: DataFrame, *, first_year: int = 2003, last_year: int = 2030, late_periods: Sequence[int] = ()) -> DataFrame:
    """One row of counts: n_rows and how many rows break each rule."""
    year = lambda c: F.year(c)
    rules = {
        "adsh_too_large": F.col("adsh") >= 10**16, "sic_too_large": F.col("sic") >= 10000,
        "period_year": (year("period") <= first_year) | (year("period") >= last_year), "accepted_year": (year("accepted") <= first_year) | (year("accepted") >= last_year),
        "flag_without_link": F.col("is_amended") != (F.col("amendment_adsh") != 0), "no_version": F.col("version") == 0,
        "version_range": (F.col("version") != 0) & ((F.col("version") < 2008) | (F.col("version") > year("accepted") + 3)), "form": ~F.col("form").isin(*POLICY.forms),
        "period_after_acceptance": (F.col("period") > F.to_date("accepted")) & ~F.col("adsh").isin(*(list(late_periods) or [-1])),
    }
    counts = sub.agg(F.count("*").alias("n_rows"), *[F.count_if(F.coalesce(r, F.lit(True))).alias(n) for n, r in rules.items()], F.greatest(F.max(year("accepted")), F.max(year("period"))).alias("__year"), F.max("version").alias("__version"))
    # no version is more than two years ahead of the latest filing
    return counts.withColumn("version_ahead", F.coalesce(F.col("__version") > F.col("__year") + 2, F.lit(False)).cast("long")).drop("__year", "__version")


def check_submissions(sub: DataFrame, *, min_rows: int = 200_000, **limits) -> list[str]:
    out = _schema(sub, SUBMISSIONS)
    if out:
        return out
    got = submission_violations(sub, **limits).first().asDict()
    n = got.pop("n_rows")
    out += [f"{n} rows, more than {min_rows} expected"] if n <= min_rows else []
    lost = sub.where("amendment_adsh <> 0").select(F.col("amendment_adsh").alias("adsh")).distinct().join(sub.select("adsh"), "adsh", "left_anti").count()
    return out + [f"{k} rows: {rule}" for rule, k in got.items() if k] + [f"{lost} amendments of unknown filings"] * bool(lost)


def fact_violations(facts: DataFrame, sub: DataFrame) -> DataFrame:
    """One row of counts: n_rows, start_after_end, orphans (filings with facts but no metadata), empty_filings (without facts)."""
    ids, known = facts.select("adsh").distinct(), sub.select("adsh").distinct()
    orphans = ids.join(known, "adsh", "left_anti").agg(F.count("*").alias("orphans"))
    empty = known.join(ids, "adsh", "left_anti").agg(F.count("*").alias("empty_filings"))
    own = facts.agg(F.count("*").alias("n_rows"), F.count_if(F.col("start") > F.col("end")).alias("start_after_end"))
    # three tables of one row each
    one = F.lit(1).alias("__one")
    return own.select(one, "*").join(orphans.select(one, "*"), "__one").join(empty.select(one, "*"), "__one").drop("__one")


def check_facts(facts: DataFrame, sub: DataFrame, *, min_rows: int = 50_000_000, max_orphans: int = 55, known_empty: int = 17) -> list[str]:
    out = _schema(facts, FACTS)
    if out:
        return out
    got = fact_violations(facts, sub).first()
    rules = {f"{got['n_rows']} rows, more than {min_rows} expected": got["n_rows"] <= min_rows, f"{got['start_after_end']} rows start after their end": got["start_after_end"] > 0, f"{got['orphans']} filings with facts have no metadata": got["orphans"] >= max_orphans, f"{got['empty_filings']} filings have no facts": got["empty_filings"] > known_empty}
    return [text for text, broken in rules.items() if broken]


def check_golden_rows(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """The expected rows that are not in `actual`; null matches null. Columns value1..4 stand for the four figures."""
    names = dict(zip(("value1", "value2", "value3", "value4"), ("reported_figure", "quarterly_figure", "reported_figure_py", "quarterly_figure_py"), strict=True))
    expected = expected.withColumnsRenamed({a: b for a, b in names.items() if a in expected.columns and b in actual.columns})
    on = None
    right = actual.select(*[F.col(c).alias(f"__{c}") for c in expected.columns])
    for c in expected.columns:
        same = expected[c].eqNullSafe(right[f"__{c}"])
        on = same if on is None else on & same
    return expected.join(right, on, "left_anti")


def missing_pivot_cells(wide: DataFrame, cells: DataFrame) -> DataFrame:
    """The rows of cells (adsh, column, value) that the wide table doesn't hold; null matches null. A column that the table doesn't have holds nothing.

    Cells meet the wide rows of their filing, which are never turned into a row for each cell.
    """
    names = [c for c in wide.columns if c != "adsh" and dict(wide.dtypes)[c] == "double"]
    if not names:
        return cells
    wanted = cells.select(F.col("adsh").alias("__a"), F.col("column").alias("__c"), F.col("value").alias("__v")).repartition("__a").distinct()
    held = F.create_map(*[x for c in names for x in (F.lit(c), F.col(c))])[F.col("__c")]
    same = (F.col("__a") == F.col("adsh")) & F.col("__c").isin(*names) & F.col("__v").eqNullSafe(held)
    return wanted.join(wide.select("adsh", *names), same, "left_anti").toDF("adsh", "column", "value")


def check_pivot_values(wide: DataFrame, cells: Sequence[tuple[int, str, float]]) -> list[str]:
    """cells: (adsh, column, value) that the wide table must hold."""
    out = []
    for adsh, column, value in cells:
        hit = wide.where((F.col("adsh") == adsh) & F.col(column).eqNullSafe(F.lit(value))).limit(1).count()
        out += [] if hit else [f"{column} of {adsh} is not {value}"]
    return out


def all_failures(facts: DataFrame, sub: DataFrame, *, submission_limits: dict | None = None, fact_limits: dict | None = None) -> list[str]:
    """Every rule that is broken."""
    return check_submissions(sub, **(submission_limits or {})) + check_facts(facts, sub, **(fact_limits or {}))


def check_all(facts: DataFrame, sub: DataFrame, **limits) -> None:
    """AssertionError with every failure (limits as in all_failures)."""
    failed = all_failures(facts, sub, **limits)
    if failed:
        raise AssertionError("; ".join(failed))
