"""The wide table: one row per filing, four columns per tag."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import POLICY, require_columns
from .checkpoints import cut
from .derive import derive_figures, impute_intervals
from .links import all_links
from .submissions import one_row_per_filing

SUFFIXES = {"quarterly_figure": "_q", "quarterly_figure_py": "_q_py", "annual_figure": "_a", "annual_figure_py": "_a_py"}


def tag_frequency(figures: DataFrame) -> DataFrame:
    return figures.groupBy("tag").agg(F.count("*").alias("n"))


def remove_infrequent_tags(figures: DataFrame) -> DataFrame:
    """Rows with a reported figure of tags that have more rows than tags rank above them (null rows count). Ties by name."""
    rank = F.row_number().over(Window.orderBy(F.col("n").desc(), "tag")) - 1
    kept = tag_frequency(figures).withColumn("rank", rank).where("n > rank").select("tag")
    return figures.join(kept, "tag", "left_semi").where("reported_figure is not null")


def sub_metadata_join(wide: DataFrame, sub: DataFrame) -> DataFrame:
    """Rows per filing with the typed columns of its submission."""
    return wide.join(sub, "adsh", "left")


def pivot_figures(figures: DataFrame, sub: DataFrame, *, tags: list[str] | None = None, as_map: bool = False) -> DataFrame:
    """One row per filing with figures: {tag}_q, _q_py, _a, _a_py and the columns of its submission.

    The tags are the distinct ones unless given. With as_map the values come in one map column instead,
    figures: tag -> (q, q_py, a, a_py), which keeps the plan small where there are thousands of tags.
    """
    require_columns(figures, ["adsh", "tag", *SUFFIXES], "figures")
    if as_map:
        values = F.struct(*[F.col(c).alias(s[1:]) for c, s in SUFFIXES.items()])
        some = figures if tags is None else figures.where(F.col("tag").isin(*tags))
        return sub_metadata_join(some.groupBy("adsh").agg(F.map_from_entries(F.collect_list(F.struct("tag", values))).alias("figures")), sub)
    if tags is None:
        figures = cut(figures.select("adsh", "tag", *SUFFIXES))
        tags = sorted(r["tag"] for r in figures.select("tag").distinct().collect() if r["tag"] is not None)
    # one shuffle for both aggregations of a pivot
    wide = figures.repartition("adsh").groupBy("adsh").pivot("tag", tags).agg(*[F.first(c).alias(c) for c in SUFFIXES]) if tags else figures.select("adsh").distinct()
    return sub_metadata_join(wide.withColumnsRenamed({f"{t}_{c}": f"{t}{s}" for t in tags for c, s in SUFFIXES.items()}), sub)


def transform_and_pivot_figures(figures: DataFrame, sub: DataFrame, *, tol_days: int = POLICY.prior_year_tolerance_days, match_form_family: bool = True, tags: list[str] | None = None, as_map: bool = False) -> DataFrame:
    """Quarterly, prior-year and annual figures of the frequent tags, one row per filing. Of several rows of a filing the highest version counts."""
    sub, figures = cut(one_row_per_filing(sub)), cut(figures)
    links = cut(all_links(sub, tol_days=tol_days, match_form_family=match_form_family))
    rows = derive_figures(remove_infrequent_tags(figures), sub, links=links)
    return pivot_figures(rows, impute_intervals(sub, links=links), tags=tags, as_map=as_map)
