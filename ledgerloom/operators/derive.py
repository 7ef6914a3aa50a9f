"""Quarterly, prior-year and annual figures, and the intervals that belong to them.

Every function finds the links it needs itself, or takes them from `links` (links.all_links, computed once).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import POLICY, require_columns
from .checkpoints import cut
from .links import all_links, gathered, linked_or_own, lookup_by_links, prev_10k_link, prev_filing_link, prior_year_link

_FIGURES = ("adsh", "tag", "reported_figure", "quarterly_figure", "reported_figure_py", "quarterly_figure_py", "is_instant")
_TOL = POLICY.prior_year_tolerance_days


def assert_known(figures: DataFrame, sub: DataFrame) -> None:
    """ValueError naming up to ten filings that have figures but no metadata."""
    unknown = figures.select("adsh").distinct().join(sub.select("adsh"), "adsh", "left_anti").limit(10).collect()
    if unknown:
        raise ValueError(f"figures of unknown filings: {sorted(r['adsh'] for r in unknown)}")


def _quarterly(keep_existing: bool) -> dict[str, Column]:
    """Both quarterly figures from _first (__first; null without any link) and the reported figures of the previous filing (__r, __r_py)."""
    first = F.coalesce("__first", F.lit(True))
    new = {}
    for now, whole, before in (("quarterly_figure", "reported_figure", "__r"), ("quarterly_figure_py", "reported_figure_py", "__r_py")):
        made = F.when(first, F.col(whole)).otherwise(F.col(whole) - F.col(before))
        new[now] = F.when(F.col("is_instant"), F.col(now)).otherwise(F.coalesce(now, made) if keep_existing else made)
    return new


def _first() -> Column:
    """Whether there is no previous filing or an annual one."""
    return (F.coalesce("prev_adsh", F.lit(0)) == 0) | F.coalesce(F.col("prev_form").startswith("10-K"), F.lit(False))


def _annual() -> Column:
    """The annual figure from __is_annual, the last annual report's figure (__k) and the figure a year earlier."""
    return F.when(F.col("__is_annual"), F.col("reported_figure")).when(~F.col("is_instant"), F.col("reported_figure") + F.col("__k") - F.col("reported_figure_py"))


def _forms(sub: DataFrame) -> DataFrame:
    return sub.groupBy("adsh").agg(F.max("form").startswith("10-K").alias("__is_annual"))


def gather_figures(figures: DataFrame, links: DataFrame) -> DataFrame:
    """Figures at their companies (links.gathered), so that the four functions, one after another, shuffle them no more; pass the same links (links.all_links) to each.

    A filing of several companies may link to another place, which sees derived figures only after a shuffle; if there is one,
    the figures come back as they are, and each function shuffles them for itself.
    """
    if not links.where("shared").isEmpty():
        return figures
    linked = links.select("adsh", "cik", "prev_adsh", "adsh_py", "prev_10k_adsh", _first().alias("__first"), F.col("form").startswith("10-K").alias("__is_annual"))
    return gathered(figures, linked, ["prev_adsh", "adsh_py", "prev_10k_adsh"], keep=["__first", "__is_annual"])


def fill_quarterly(figures: DataFrame, sub: DataFrame, *, keep_existing: bool = True, check: bool = True, links: DataFrame | None = None) -> DataFrame:
    """Quarterly figures of durations: the reported one if there is no earlier filing of the same start or that is annual, else the difference. Instants stay."""
    require_columns(figures, _FIGURES, "figures")
    if check:
        assert_known(figures, sub)
    link = (prev_filing_link(sub) if links is None else links).select("adsh", "prev_adsh", _first().alias("__first"))
    rows = lookup_by_links(figures, link, {"prev_adsh": {"reported_figure": "__r", "reported_figure_py": "__r_py"}}, keep=["__first"])
    return rows.withColumns(_quarterly(keep_existing)).select(*figures.columns)


def fill_prior_year(figures: DataFrame, sub: DataFrame, *, tol_days: int = _TOL, match_form_family: bool = True, links: DataFrame | None = None) -> DataFrame:
    """Missing prior-year figures from the filing a year earlier."""
    require_columns(figures, _FIGURES, "figures")
    link = prior_year_link(sub, tol_days=tol_days, match_form_family=match_form_family) if links is None else links.select("adsh", "adsh_py", "py_diff_days")
    rows = lookup_by_links(figures, link, {"adsh_py": {"reported_figure": "__r", "quarterly_figure": "__q"}}, keep=[])
    return rows.withColumns({"reported_figure_py": F.coalesce("reported_figure_py", "__r"), "quarterly_figure_py": F.coalesce("quarterly_figure_py", "__q")}).select(*figures.columns)


def annual_current(figures: DataFrame, sub: DataFrame, *, tol_days: int = _TOL, links: DataFrame | None = None) -> DataFrame:
    """annual_figure: the reported one of annual reports; of other durations reported + last annual - reported a year earlier; null for other instants."""
    require_columns(figures, _FIGURES, "figures")
    link = prev_10k_link(sub, tol_days=tol_days) if links is None else links.select("adsh", "prev_10k_adsh", "prev_10k_diff_days")
    rows = lookup_by_links(figures, link.join(_forms(sub), "adsh", "left"), {"prev_10k_adsh": {"reported_figure": "__k"}}, keep=["__is_annual"])
    return rows.withColumn("annual_figure", _annual()).select(*figures.columns, "annual_figure")


def annual_prior_year(figures: DataFrame, sub: DataFrame, *, tol_days: int = _TOL, match_form_family: bool = True, links: DataFrame | None = None) -> DataFrame:
    """annual_figure_py: the annual figure of the filing a year earlier."""
    require_columns(figures, ["adsh", "tag", "annual_figure"], "figures")
    link = prior_year_link(sub, tol_days=tol_days, match_form_family=match_form_family) if links is None else links.select("adsh", "adsh_py", "py_diff_days")
    return lookup_by_links(figures, link, {"adsh_py": {"annual_figure": "annual_figure_py"}}, keep=[]).select(*figures.columns, "annual_figure_py")


def derive_figures(figures: DataFrame, sub: DataFrame, *, tol_days: int = _TOL, match_form_family: bool = True, keep_existing: bool = True, check: bool = True, links: DataFrame | None = None) -> DataFrame:
    """fill_quarterly, fill_prior_year, annual_current and annual_prior_year, with two rounds of look-ups instead of four.

    What is looked up in the figures as they came (the previous filing's, last year's and the last annual report's reported figures) is
    looked up in one round; what is derived itself (last year's quarterly and annual figures) in a second one, which shuffles nothing more.
    """
    require_columns(figures, _FIGURES, "figures")
    if check:
        assert_known(figures, sub)
    links = cut(all_links(sub, tol_days=tol_days, match_form_family=match_form_family)) if links is None else links
    rows = gather_figures(figures, links)
    linked = links.select("adsh", "prev_adsh", _first().alias("__first"), "adsh_py", "prev_10k_adsh", F.col("form").startswith("10-K").alias("__is_annual"))
    given = {"prev_adsh": {"reported_figure": "__r", "reported_figure_py": "__r_py"}, "adsh_py": {"reported_figure": "__last"}, "prev_10k_adsh": {"reported_figure": "__k"}}
    at_hand = rows.columns
    rows = lookup_by_links(rows, linked, given, keep=["__first", "__is_annual"])
    rows = rows.withColumns(_quarterly(keep_existing)).withColumn("reported_figure_py", F.coalesce("reported_figure_py", "__last"))
    rows = rows.withColumn("annual_figure", _annual()).select(*at_hand, "annual_figure")
    out = lookup_by_links(rows, links.select("adsh", "adsh_py"), {"adsh_py": {"quarterly_figure": "__q", "annual_figure": "annual_figure_py"}}, keep=[])
    return out.withColumn("quarterly_figure_py", F.coalesce("quarterly_figure_py", "__q")).select(*figures.columns, "annual_figure", "annual_figure_py")


def impute_intervals(sub: DataFrame, *, tol_days: int = _TOL, match_form_family: bool = True, links: DataFrame | None = None) -> DataFrame:
    """Submissions with annual and quarterly intervals, current and prior year, instead of the four reported anchors."""
    require_columns(sub, ["adsh", "cik", "form", "start_rep", "end_rep", "start_rep_py", "end_rep_py", "start_q", "end_q", "start_q_py", "end_q_py", "is_amended"], "submissions")
    rows = sub.withColumns({"end_a": F.col("end_rep"), "end_a_py": F.col("end_rep_py"), "end_q": F.coalesce("end_q", "end_rep"), "end_q_py": F.coalesce("end_q_py", "end_rep_py")})
    rows = rows.join((all_links(sub, tol_days=tol_days, match_form_family=match_form_family) if links is None else links).select("adsh", "prev_10k_adsh", "adsh_py", "prev_adsh"), "adsh")

    def follow(rows: DataFrame, there: DataFrame, link_col: str, **columns: str) -> DataFrame:
        there = there.select(F.col("adsh").alias("__to"), *[F.col(c).alias(n) for n, c in columns.items()])
        return rows.withColumn("__to", linked_or_own(link_col)).join(there, "__to", "left").drop("__to")

    rows = follow(rows, sub, "prev_10k_adsh", __start_k="start_rep")
    rows = follow(rows, sub, "adsh_py", __start_py="start_rep")
    rows = follow(rows, rows, "prev_adsh", __prev_q="end_q", __prev_rep="end_rep")
    made = F.when(F.col("prev_adsh") == 0, F.col("start_rep")).otherwise(F.date_add(F.coalesce("__prev_q", "__prev_rep"), 1))
    rows = cut(rows.withColumns({"start_a": F.when(F.col("form").startswith("10-K"), F.col("start_rep")).otherwise(F.col("__start_k")), "start_a_py": F.col("__start_py"), "start_q": F.coalesce("start_q", made)}))
    rows = follow(rows, rows, "adsh_py", __sq="start_q", __eq="end_q")
    rows = rows.withColumns({"start_q_py": F.coalesce("start_q_py", "__sq"), "end_q_py": F.coalesce("end_q_py", "__eq")})
    kept = [c for c in sub.columns if c not in ("start_rep", "end_rep", "start_rep_py", "end_rep_py")]
    return rows.select(*kept, "start_a", "end_a", "start_a_py", "end_a_py")
