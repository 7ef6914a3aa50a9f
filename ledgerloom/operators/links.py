"""As-of links between the filings of a company. 0 stands for no link.

Each link is a running maximum over the filings of a company in order of their ends, so that a company with many filings
costs its filings and not its pairs. Links have one row per filing, whatever number of rows it has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import add_years, form_family
from ..schemas import POLICY, require_columns


def _days(day: Column) -> Column:
    return F.datediff(day, F.lit("1970-01-01").cast("date"))


def _usable(exclude_amended: bool) -> Column:
    return ~F.coalesce("is_amended", F.lit(False)) if exclude_amended else F.lit(True)


def _with_unlinked(found: DataFrame, sub: DataFrame) -> DataFrame:
    """Links (adsh, b) and a row without a link for every filing."""
    return found.unionByName(sub.select("adsh"), allowMissingColumns=True)


def _rows(sub: DataFrame, start: Column, end_col: str, family: Column, exclude_amended: bool) -> DataFrame:
    """Filings with a company and an end: (adsh, cik, form, family, start, day, asked: the day a year earlier, usable)."""
    asked = _days(add_years(F.col(end_col), -1)).alias("asked")
    return sub.where(F.col("cik").isNotNull() & F.col(end_col).isNotNull()).select("adsh", "cik", "form", family.alias("family"), start.alias("start"), _days(F.col(end_col)).alias("day"), asked, _usable(exclude_amended).alias("usable"))


def _add_prev_10k(rows: DataFrame, tol_days: int) -> DataFrame:
    """Rows with k: day, adsh and lag of the latest annual report."""
    earlier = Window.partitionBy("cik").orderBy("day").rangeBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("last", F.max(F.when(F.col("usable") & F.col("form").startswith("10-K"), F.struct("day", "adsh"))).over(earlier))
    lag = F.col("day") - F.col("last.day")
    return rows.withColumn("k", F.when(lag <= 365 + tol_days, F.struct("last.day", "last.adsh", lag.alias("lag")))).drop("last")


def _add_prev_filing(rows: DataFrame) -> DataFrame:
    """Rows with p: day, adsh and form of the last filing of the same start."""
    earlier = Window.partitionBy("cik", "start").orderBy("day").rangeBetween(Window.unboundedPreceding, -1)
    last = F.max(F.when(F.col("usable"), F.struct("day", "adsh", "form"))).over(earlier)
    return rows.withColumn("p", last).withColumn("p", F.when(F.col("start").isNotNull(), F.col("p")))


def _add_prior_year(rows: DataFrame, tol_days: int) -> DataFrame:
    """Rows with y: minus the days off, end and adsh of the filing nearest to a year earlier.

    Every filing is placed on its own day, as one that may be found, and on the day asked for, in the same partition.
    """
    spots = F.array(F.struct(F.col("asked").alias("day"), F.lit(False).alias("given")), F.struct("day", F.lit(True).alias("given")))
    both = rows.withColumn("spot", F.explode(spots)).withColumns({"day": F.col("spot.day"), "given": F.col("spot.given")}).drop("spot")
    upto = Window.partitionBy("cik", "family").orderBy("day").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy("cik", "family").orderBy(F.col("day").desc()).rangeBetween(Window.unboundedPreceding, -1)
    given = F.col("given") & F.col("usable")
    before = F.max(F.when(given, F.struct("day", "adsh"))).over(upto)
    behind = F.max(F.when(given, F.struct((-F.col("day")).alias("minus"), "adsh"))).over(after)
    found = both.withColumns({"x": before, "z": behind}).where(~F.col("given"))
    off = lambda day: F.abs(day - F.col("day"))
    option = lambda day, adsh: F.when(off(day) <= tol_days, F.struct((-off(day)).alias("near"), day.alias("end"), adsh.alias("adsh")))
    return found.withColumn("y", F.greatest(option(F.col("x.day"), F.col("x.adsh")), option(-F.col("z.minus"), F.col("z.adsh")))).drop("x", "z", "given")


_PREV_10K = ("coalesce(k.adsh, 0) AS prev_10k_adsh", "cast(coalesce(k.lag, 0) AS smallint) AS prev_10k_diff_days")
_PRIOR_YEAR = ("coalesce(y.adsh, 0) AS adsh_py", "cast(coalesce(-y.near, 0) AS smallint) AS py_diff_days")
_PREV_FILING = ("coalesce(p.adsh, 0) AS prev_adsh", "p.form AS prev_form")


def prev_10k_link(sub: DataFrame, *, tol_days: int = POLICY.prior_year_tolerance_days, end_col: str = "end_rep", exclude_amended: bool = True) -> DataFrame:
    """(adsh, prev_10k_adsh, prev_10k_diff_days): the latest annual report that ended 1 to 365 + tol_days days earlier; ties to the larger adsh."""
    require_columns(sub, ["adsh", "cik", "form", end_col, "is_amended"], "submissions")
    met = _add_prev_10k(_rows(sub, F.lit(None), end_col, F.lit(""), exclude_amended), tol_days).select("adsh", "k")
    return _with_unlinked(met, sub).groupBy("adsh").agg(F.max("k").alias("k")).selectExpr("adsh", *_PREV_10K)


def prior_year_link(sub: DataFrame, *, tol_days: int = POLICY.prior_year_tolerance_days, match_form_family: bool = True, end_col: str = "end_rep", exclude_amended: bool = True) -> DataFrame:
    """(adsh, adsh_py, py_diff_days): the filing that ended nearest to a year earlier, within tol_days; ties to the later end, then the larger adsh.

    The nearest is the last that ended up to the wanted day or the first after it: one running maximum for each side.
    """
    require_columns(sub, ["adsh", "cik", "form", end_col, "is_amended"], "submissions")
    family = form_family(F.col("form")) if match_form_family else F.lit("")
    met = _add_prior_year(_rows(sub, F.lit(None), end_col, family, exclude_amended), tol_days).select("adsh", "y")
    return _with_unlinked(met, sub).groupBy("adsh").agg(F.max("y").alias("y")).selectExpr("adsh", *_PRIOR_YEAR)


def prev_filing_link(sub: DataFrame, *, start_col: str = "start_rep", end_col: str = "end_rep", exclude_amended: bool = True) -> DataFrame:
    """(adsh, prev_adsh, prev_form): the filing with the same start that ended last before this one; ties to the larger adsh."""
    require_columns(sub, ["adsh", "cik", "form", start_col, end_col, "is_amended"], "submissions")
    met = _add_prev_filing(_rows(sub, F.col(start_col), end_col, F.lit(""), exclude_amended)).select("adsh", "p")
    return _with_unlinked(met, sub).groupBy("adsh").agg(F.max("p").alias("p")).selectExpr("adsh", *_PREV_FILING)


def all_links(sub: DataFrame, *, tol_days: int = POLICY.prior_year_tolerance_days, match_form_family: bool = True) -> DataFrame:
    """(adsh, prev_10k_adsh, prev_10k_diff_days, adsh_py, py_diff_days, prev_adsh, prev_form, form, cik, shared): the three links of each filing, to be computed once and passed on.

    form and cik are the largest ones of the filing's rows, and shared is whether it has several companies. Filings are
    sent to their company once for all links.
    """
    require_columns(sub, ["adsh", "cik", "form", "start_rep", "end_rep", "is_amended"], "submissions")
    family = form_family(F.col("form")) if match_form_family else F.lit("")
    rows = _rows(sub, F.col("start_rep"), "end_rep", family, True).repartition("cik")
    met = _add_prior_year(_add_prev_filing(_add_prev_10k(rows, tol_days)), tol_days).select("adsh", "k", "y", "p")
    known = met.unionByName(sub.select("adsh", "form", "cik"), allowMissingColumns=True)
    best = known.groupBy("adsh").agg(*[F.max(c).alias(c) for c in ("k", "y", "p", "form", "cik")], F.coalesce(F.min("cik") < F.max("cik"), F.lit(False)).alias("shared"))
    return best.selectExpr("adsh", *_PREV_10K, *_PRIOR_YEAR, *_PREV_FILING, "form", "cik", "shared")


def linked_or_own(link_col: str) -> Column:
    """The linked filing; for a row without a link an id of its own that no filing has, so that such rows don't meet in one task."""
    return F.when(F.coalesce(link_col, F.lit(0)) == 0, -1 - F.abs(F.coalesce("adsh", F.lit(0)))).otherwise(F.col(link_col))


def gathered(figures: DataFrame, links: DataFrame, names: Sequence[str], *, keep: Sequence[str] = ()) -> DataFrame:
    """Figures with the columns `keep` of their links, each at the place of its filing and of the filings that link to it (those links in `names`).

    A place is a company where links name one (cik), else a filing; figures are dealt by place and tag, so what is looked
    up in them afterwards is at hand. Each has the filings at its place that ask for it by a link (__by_{link}), and
    __own tells the row of its own filing's place from copies for other places. Figures are shuffled twice, once by filing. Where no
    link leaves a place, there are no copies, and any number of look-ups can follow each other.
    """
    home = F.coalesce(F.col("cik") if "cik" in links.columns else F.lit(None), -1 - F.abs("adsh")).alias("__home")
    known = links.where("adsh is not null").select("adsh", home, *keep, *names)
    asks = [known.where(F.coalesce(c, F.lit(0)) != 0).select(F.col(c).alias("adsh"), F.struct(F.col("__home").alias("place"), F.col("adsh").alias("to"), F.lit(k).alias("kind")).alias("__ask")) for k, c in enumerate(names)]
    both = known.drop(*names)
    for ask in asks:
        both = both.unionByName(ask, allowMissingColumns=True)
    filings = both.groupBy("adsh").agg(*[F.first(c, ignorenulls=True).alias(c) for c in (*keep, "__home")], F.collect_list("__ask").alias("__asks"))
    apart = -1 - F.abs("adsh")  # the place of a filing that has no links
    asked = lambda place, k: F.transform(F.filter("__asks", lambda a: (a["place"] == place) & (a["kind"] == k)), lambda a: a["to"])
    own = F.coalesce("__home", apart)
    spots = F.transform(F.array_union(F.array(own), F.col("__asks.place")), lambda p: F.struct(p.alias("__place"), (p == own).alias("__own"), *[asked(p, k).alias(f"__by_{c}") for k, c in enumerate(names)]))
    filings = filings.select("adsh", *keep, spots.alias("__spots"))
    solo = F.when(F.col("adsh").isNull() | F.col("tag").isNull(), F.monotonically_increasing_id())
    rows = figures.withColumn("__solo", solo).join(filings, "adsh", "left")
    nobody = F.array().cast("array<bigint>")
    # figures without a filing are nobody's and stay apart
    alone = F.array(F.struct(F.coalesce(apart, "__solo").alias("__place"), F.lit(True).alias("__own"), *[nobody.alias(f"__by_{c}") for c in names]))
    rows = rows.withColumn("__spot", F.explode(F.coalesce("__spots", alone)))
    return rows.select(*figures.columns, *keep, "__solo", "__spot.*").repartition("__place", "tag")


def look_up(rows: DataFrame, wanted: dict[str, dict[str, str]]) -> DataFrame:
    """Gathered figures with values of the same tag in the linked filings: wanted maps a link to {figures column: new name}. Nothing is shuffled; copies for other places go. (adsh, tag) must be unique, or a run fails."""
    spot = lambda to, kind: F.struct(to.alias("to"), kind.alias("kind"))
    here = F.array(spot(F.col("adsh"), F.when(F.col("__own"), 0).otherwise(-1)))
    asked = lambda link, kind: F.transform(f"__by_{link}", lambda to: spot(to, F.lit(kind)))
    asks = [asked(c, k) for k, c in enumerate(wanted, 1)]
    kind, new = F.col("__ask.kind"), [n for columns in wanted.values() for n in columns.values()]
    # a figure that is sent to others leaves its own lists behind
    kept = [F.when(kind == 0, F.col(c)).alias(c) if c.startswith("__by_") else F.col(c) for c in rows.columns if c != "adsh"]
    sent = rows.withColumn("__ask", F.explode(F.concat(here, *asks))).select(F.col("__ask.to").alias("adsh"), kind.alias("__kind"), *kept)
    met = Window.partitionBy("__place", "tag", "adsh", "__solo")
    found = {n: F.first(F.when(F.col("__kind") == k, F.col(c)), ignorenulls=True).over(met) for k, columns in enumerate(wanted.values(), 1) for c, n in columns.items()}
    out = sent.select("*", F.count_if(F.col("__kind") == 0).over(met).alias("__n"), *[c.alias(n) for n, c in found.items()])
    what = F.concat(F.lit("several figures of filing "), F.col("adsh").cast("string"), F.lit(" and tag "), F.col("tag").cast("string"))
    out = out.where(F.when(F.col("__n") > 1, F.raise_error(what).cast("boolean")).otherwise(F.col("__kind") == 0))
    return out.select(*rows.columns, *new)


def lookup_by_links(figures: DataFrame, links: DataFrame, wanted: dict[str, dict[str, str]], *, keep: Sequence[str] | None = None) -> DataFrame:
    """Figures with columns of their links (those in `keep`, else all) and values of the same tag in the linked filings: wanted maps a link to {figures column: new name}.

    The figures are shuffled twice for any number of links, and not at all if they are gathered (they then have the columns
    in `keep`). (adsh, tag) must be unique, or a run fails; links have one row per filing.
    """
    new = [n for columns in wanted.values() for n in columns.values()]
    if "__place" in figures.columns:
        return look_up(figures, wanted).select(*figures.columns, *new)
    extra = [c for c in (links.columns if keep is None else keep) if c != "adsh"]
    aside = {c: f"__kept_{c}" for c in extra}  # a link may be kept and followed
    links = links.withColumns({k: F.col(c) for c, k in aside.items()})
    rows = look_up(gathered(figures, links, list(wanted), keep=list(aside.values())), wanted)
    return rows.select(*figures.columns, *[F.col(k).alias(c) for c, k in aside.items()], *new)


def lookup_by_link(figures: DataFrame, link: DataFrame, link_col: str, columns: dict[str, str]) -> DataFrame:
    """Figures with values of the same tag in the linked filing: columns maps a figures column to its new name. (adsh, tag) must be unique, or a run fails."""
    return lookup_by_links(figures, link, {link_col: columns})
