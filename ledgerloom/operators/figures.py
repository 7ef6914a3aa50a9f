"""Facts to figures: one row per filing and tag with reported, quarterly and prior-year values."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import VALUES, require_columns
from .amendments import merge_amendments
from .arcs import apply_arcs_by_version, keep_first_by_priority
from .checkpoints import cut
from .clean import Corrections, correct_scale_outliers, drop_contradictions, normalize_fact_types, remove_huge_values, split_instant_duration
from .windows import compute_instant_values, compute_period_values, infer_reporting_windows


def figures_from_clean(facts: DataFrame, sub: DataFrame, *, arcs: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(figures, submissions with windows) from facts that are unique by (adsh, tag, start, end). Durations come before instants of one tag; arcs, if given, fill missing totals."""
    rows = cut(facts.repartition("adsh"))
    instants, durations = split_instant_duration(rows)
    windows = cut(infer_reporting_windows(rows, sub))
    values, enriched = compute_period_values(durations, sub, windows)
    first = values.withColumn("is_instant", F.lit(False))
    both = keep_first_by_priority(first, compute_instant_values(instants, windows).withColumn("is_instant", F.lit(True)))
    names = dict(zip(("value1", "value2", "value3", "value4"), VALUES, strict=True))
    figures = both.withColumnsRenamed(names).select("adsh", "tag", *VALUES, F.lit(False).alias("is_computed"), "is_instant")
    return (apply_arcs_by_version(figures, sub, arcs) if arcs is not None else figures), enriched


class BaseFigures(NamedTuple):
    figures: DataFrame
    submissions: DataFrame
    corrections: Corrections


def report_base_figures(facts: DataFrame, sub: DataFrame, *, arcs: DataFrame | None = None) -> BaseFigures:
    """Types, amendments, contradictions, scale outliers and huge values, then figures_from_clean; and how many values were rescaled."""
    require_columns(facts, ["adsh", "tag", "start", "end", "value"], "facts")
    require_columns(sub, ["adsh", "cik", "period", "accepted", "amendment_adsh", "version"], "submissions")
    rows, corrections = correct_scale_outliers(drop_contradictions(merge_amendments(cut(normalize_fact_types(facts)), sub)), sub)
    return BaseFigures(*figures_from_clean(remove_huge_values(rows), sub, arcs=arcs), corrections)


def build_base_figures(facts: DataFrame, sub: DataFrame, *, arcs: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """report_base_figures without the report."""
    return report_base_figures(facts, sub, arcs=arcs)[:2]
