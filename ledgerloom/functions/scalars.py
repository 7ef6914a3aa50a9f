"""Scalar rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import POLICY


def accession_to_long(text: Column) -> Column:
    """0001234567-21-000123 -> 123456721000123."""
    return F.replace(text, F.lit("-"), F.lit("")).cast("long")


def long_to_accession(adsh: Column) -> Column:
    """The 18 digits of an accession number."""
    return F.lpad(adsh.cast("string"), 18, "0")


def filer_of(adsh: Column) -> Column:
    """The filer prefix of an accession number; not always the issuer."""
    return F.call_function("div", adsh, F.lit(100_000_000))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def to_number(text: Column) -> Column:
    """Double, or null where the text is none or not a number."""
    return nan_to_null(text.try_cast("double"))


def add_years(day: Column, n: int) -> Column:
    """Calendar years; 29 February goes to the 28th."""
    return F.add_months(day, 12 * n)


def form_family(form: Column) -> Column:
    return F.when(form.startswith("10-K"), "10-K").when(form.startswith("10-Q"), "10-Q").otherwise("OTHER")


def value_adj(start: Column, end: Column, value: Column) -> Column:
    """Absolute value, of durations scaled to a quarter."""
    days = F.greatest(F.datediff(end, start), F.lit(POLICY.min_period_days))
    return F.when(start == end, F.abs(value)).otherwise(F.abs(value / days * POLICY.min_period_days))


def instance_file_name(name: Column) -> Column:
    """The instance document of a primary document: the last .htm becomes _htm.xml."""
    return F.when(name.endswith(".xml"), name).otherwise(F.concat(F.regexp_replace(name, r"\.htm(?!.*\.htm)", "_htm"), F.lit(".xml")))


def taxonomy_version(text: Column) -> Column:
    """The first us-gaap year in a document; 0 if there is none."""
    return F.coalesce(F.nullif(F.regexp_extract(text, r"us-gaap/(20\d{2})", 1), F.lit("")).try_cast("int"), F.lit(0))
