"""Table schemas and the policy constants."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

FACTS = "adsh long, tag string, start date, end date, value double"
SUBMISSIONS = "adsh long, cik long, sic long, form string, period date, accepted timestamp_ntz, version int, amendment_adsh long, is_amended boolean, ticker string"
WINDOWS = "adsh long, start date, end date, enum tinyint"
ARCS = "version int, statement string, seq int, `from` string, `to` string, weight double"
VALUES = ("reported_figure", "quarterly_figure", "reported_figure_py", "quarterly_figure_py")
KEY = ("adsh", "tag", "start", "end")


@dataclass(frozen=True)
class Policy:
    """Fixed values that results depend on."""

    max_abs_value: float = 5e12
    large_value_tags: tuple[str, ...] = ("NotionalAmountOfDerivatives", "DerivativeNotionalAmount", "DerivativeAssetNotionalAmount", "DerivativeLiabilityNotionalAmount")
    min_period_days: int = 90
    period_tolerance_days: int = 30
    prior_year_tolerance_days: int = 10
    outlier_neighbour_days: int = 120
    max_outlier_rounds: int = 10
    second_range_share: float = 0.3
    forms: tuple[str, ...] = ("10-Q", "10-K", "10-Q/A", "10-K/A")


POLICY = Policy()


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "table") -> DataFrame:
    """The table itself; ValueError naming the missing columns, sorted."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{what} misses columns: {missing}")
    return df
