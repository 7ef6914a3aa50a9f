"""The registered queries over the driver's tables and the same results as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import scalars
from .operators import amendments, arcs, checks, clean, derive, figures, links, pivot, submissions, windows
from .operators.checkpoints import cut
from .plans import adapter
from .schemas import VALUES
from .sources import landed

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None):
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _days(df: DataFrame) -> DataFrame:
    """Dates and times as text, so that engines compare alike."""
    return df.withColumns({c: F.col(c).cast("string") for c, t in df.dtypes if t in ("date", "timestamp_ntz")})


def _rounded(df: DataFrame) -> DataFrame:
    """Sums and differences of prices to the cent."""
    return df.withColumns({c: F.round(c, 2) for c, t in df.dtypes if t == "double"})


SUB = """
sub0 AS (
  SELECT o_orderkey + 1 AS adsh, o_custkey AS cik,
         CASE o_orderpriority WHEN '1-URGENT' THEN '10-K' WHEN '2-HIGH' THEN '10-K/A' ELSE '10-Q' END AS form,
         last_day(CAST(o_orderdate AS DATE)) AS period, o_orderdate AS accepted,
         CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE CAST(year(o_orderdate) AS INT) END AS version
  FROM orders),
sub AS (
  SELECT *, CASE WHEN last_ <> adsh THEN last_ ELSE 0 END AS amendment_adsh, last_ <> adsh AS is_amended
  FROM (SELECT *, last_value(adsh) OVER (PARTITION BY cik, period ORDER BY accepted, adsh ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_ FROM sub0))"""

FACTS = """
facts AS (
  SELECT l.l_orderkey + 1 AS adsh, p.p_type AS tag,
         CAST(CASE l.l_linenumber % 5 WHEN 1 THEN date_trunc('year', o.o_orderdate) WHEN 2 THEN date_trunc('quarter', o.o_orderdate)
              WHEN 3 THEN date_trunc('year', o.o_orderdate) - INTERVAL 1 YEAR WHEN 4 THEN date_trunc('quarter', o.o_orderdate) - INTERVAL 1 YEAR
              ELSE last_day(CAST(o.o_orderdate AS DATE)) END AS DATE) AS start,
         CAST(CASE WHEN l.l_linenumber % 5 IN (3, 4) THEN last_day(CAST(o.o_orderdate AS DATE)) - INTERVAL 1 YEAR ELSE last_day(CAST(o.o_orderdate AS DATE)) END AS DATE) AS end_,
         l.l_extendedprice AS value
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey)"""

MERGED = """
given AS (SELECT s.amendment_adsh AS adsh, f.tag, f.start, f.end_, f.value, s.accepted, s.adsh AS source FROM facts f JOIN sub s ON f.adsh = s.adsh WHERE s.amendment_adsh <> 0),
lacking AS (
  SELECT *, rank() OVER (PARTITION BY adsh, tag, start, end_ ORDER BY accepted, source) AS rk FROM given g
  WHERE NOT EXISTS (SELECT 1 FROM facts f WHERE f.adsh = g.adsh AND f.tag = g.tag AND f.start = g.start AND f.end_ = g.end_)),
merged AS (SELECT adsh, tag, start, end_, value FROM facts UNION SELECT adsh, tag, start, end_, value FROM lacking WHERE rk = 1)"""

CLEAN = """
clean AS (SELECT adsh, tag, start, end_, min(value) AS value FROM merged GROUP BY ALL HAVING count(DISTINCT value) = 1)"""

WINDOWS = """
ends AS (SELECT f.adsh, f.end_, count(*) AS n, any_value(s.period) AS period FROM {facts} f JOIN sub s ON f.adsh = s.adsh WHERE year(f.end_) <= 2100 GROUP BY f.adsh, f.end_),
best AS (SELECT adsh, end_ FROM (SELECT *, row_number() OVER (PARTITION BY adsh ORDER BY n DESC, abs(datediff('day', end_, period)), end_ DESC) AS rk FROM ends WHERE abs(datediff('day', end_, period)) < 30) WHERE rk = 1),
best_py AS (SELECT adsh, end_ FROM (SELECT *, row_number() OVER (PARTITION BY adsh ORDER BY n DESC, abs(datediff('day', CAST(end_ + INTERVAL 1 YEAR AS DATE), period)), end_ DESC) AS rk FROM ends WHERE abs(datediff('day', CAST(end_ + INTERVAL 1 YEAR AS DATE), period)) < 30) WHERE rk = 1),
ranges AS (SELECT f.adsh, f.end_, f.start, count(*) AS n FROM {facts} f JOIN best b ON f.adsh = b.adsh AND f.end_ = b.end_ WHERE f.start <> f.end_ AND CAST(f.start + INTERVAL 1 YEAR AS DATE) + 10 > f.end_ GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY adsh ORDER BY n DESC, start) AS rk, max(n) OVER (PARTITION BY adsh) AS most FROM ranges),
two AS (SELECT adsh, start, end_, row_number() OVER (PARTITION BY adsh ORDER BY start) AS enum FROM ranked WHERE rk = 1 OR rk = 2 AND n >= 0.3 * most),
py AS (SELECT f.adsh, f.end_, f.start, count(*) AS n FROM {facts} f JOIN best_py b ON f.adsh = b.adsh AND f.end_ = b.end_ GROUP BY ALL),
aligned AS (
  SELECT p.adsh, p.start, p.end_, t.enum + 2 AS enum, row_number() OVER (PARTITION BY p.adsh, t.enum ORDER BY p.n DESC, p.start) AS rk
  FROM py p JOIN two t ON p.adsh = t.adsh WHERE abs(datediff('day', p.start, CAST(t.start - INTERVAL 1 YEAR AS DATE))) < 10),
windows AS (SELECT adsh, start, end_, enum FROM two UNION ALL SELECT adsh, start, end_, enum FROM aligned WHERE rk = 1)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_RAW_WINDOWS = WINDOWS.replace("{facts}", "facts")
_CLEAN_WINDOWS = WINDOWS.replace("{facts}", "clean")
_PERIOD = """
SELECT f.adsh, f.tag, max(CASE WHEN enum = 1 THEN value END) AS value1, max(CASE WHEN enum = 2 THEN value END) AS value2,
       max(CASE WHEN enum = 3 THEN value END) AS value3, max(CASE WHEN enum = 4 THEN value END) AS value4
FROM {facts} f JOIN windows w ON f.adsh = w.adsh AND f.start = w.start AND f.end_ = w.end_ {where}
GROUP BY f.adsh, f.tag HAVING count(CASE WHEN enum = 1 THEN 1 END) > 0"""
_INSTANT = """
SELECT f.adsh, f.tag, max(CASE WHEN f.end_ = e1 THEN value END) AS value1, max(CASE WHEN f.end_ = e2 THEN value END) AS value2,
       max(CASE WHEN f.end_ = e3 THEN value END) AS value3, max(CASE WHEN f.end_ = e4 THEN value END) AS value4
FROM {facts} f LEFT JOIN (SELECT adsh, max(CASE WHEN enum = 1 THEN end_ END) AS e1, max(CASE WHEN enum = 2 THEN end_ END) AS e2, max(CASE WHEN enum = 3 THEN end_ END) AS e3, max(CASE WHEN enum = 4 THEN end_ END) AS e4 FROM windows GROUP BY adsh) w ON f.adsh = w.adsh
WHERE f.start = f.end_ GROUP BY f.adsh, f.tag"""

# ---- submissions and amendments


@_query(_with(SUB) + " SELECT adsh, amendment_adsh, is_amended FROM sub")
def amendment_flags(spark, sf_dir):
    return adapter.submissions(spark, sf_dir).select("adsh", "amendment_adsh", "is_amended")


@_query(
    _with(SUB, "src AS (SELECT amendment_adsh AS adsh, arg_max(version, {'a': accepted, 'b': adsh}) AS v FROM sub WHERE amendment_adsh <> 0 GROUP BY 1)", "rows_ AS (SELECT s.*, coalesce(nullif(s.version, 0), nullif(src.v, 0)) AS v FROM sub s LEFT JOIN src ON s.adsh = src.adsh)")
    + """ SELECT adsh, CAST(coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY cik ORDER BY accepted, adsh ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                            first_value(v IGNORE NULLS) OVER (PARTITION BY cik ORDER BY accepted, adsh ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS INT) AS version FROM rows_"""
)
def repair_version(spark, sf_dir):
    return submissions.repair_version(adapter.submissions(spark, sf_dir)).select("adsh", "version")


@_query(_with(SUB) + " SELECT adsh AS adsh_original, last_ AS adsh_canonical FROM sub")
def canonical_map(spark, sf_dir):
    chain = F.lead("adsh", 1, 0).over(Window.partitionBy("cik", "period").orderBy("accepted", "adsh"))
    return amendments.canonical_adsh_map(adapter.submissions(spark, sf_dir).withColumn("amendment_adsh", chain))


@_query(_with(SUB, FACTS) + " SELECT s.last_ AS adsh, f.tag, count(*) AS n, CAST(sum(CAST(f.value AS DECIMAL(18, 2))) AS DOUBLE) AS total FROM facts f JOIN sub s ON f.adsh = s.adsh GROUP BY 1, 2")
def apply_canonical(spark, sf_dir):
    rows = amendments.apply_canonical_adsh(adapter.facts(spark, sf_dir), amendments.canonical_adsh_map(adapter.submissions(spark, sf_dir)))
    return rows.groupBy("adsh", "tag").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"))


@_query(_with(SUB, FACTS, "m AS (SELECT s.last_ AS adsh, f.tag, f.start, f.end_, f.value, s.accepted FROM facts f JOIN sub s ON f.adsh = s.adsh)") + " SELECT adsh, tag, CAST(start AS VARCHAR) AS start, CAST(end_ AS VARCHAR) AS end_, value FROM (SELECT *, row_number() OVER (PARTITION BY adsh, tag, start, end_ ORDER BY accepted DESC, value) AS rk FROM m) WHERE rk = 1")
def dedupe_latest(spark, sf_dir):
    sub = adapter.submissions(spark, sf_dir)
    rows = amendments.apply_canonical_adsh(adapter.facts(spark, sf_dir).withColumn("source", F.col("adsh")), amendments.canonical_adsh_map(sub))
    return _days(amendments.dedupe_latest_by_acceptance(rows, sub, source_col="source").drop("source").withColumnRenamed("end", "end_"))


@_query(_with(SUB, FACTS, MERGED) + " SELECT adsh, tag, CAST(start AS VARCHAR) AS start, CAST(end_ AS VARCHAR) AS end_, value FROM merged")
def merge_amendments(spark, sf_dir):
    return _days(amendments.merge_amendments(adapter.facts(spark, sf_dir), adapter.submissions(spark, sf_dir)).withColumnRenamed("end", "end_"))


@_query(_with(SUB) + " SELECT last_ AS adsh, strftime(max(accepted), '%Y-%m-%d %H:%M:%S') AS accepted FROM sub GROUP BY last_")
def accepted_by_canonical(spark, sf_dir):
    sub = adapter.submissions(spark, sf_dir)
    return amendments.accepted_by_canonical(sub, amendments.canonical_adsh_map(sub)).select("adsh", F.date_format("accepted", "yyyy-MM-dd HH:mm:ss").alias("accepted"))


# ---- cleaning


@_query(_with(FACTS.replace("facts AS", "merged AS"), CLEAN) + " SELECT adsh, tag, CAST(start AS VARCHAR) AS start, CAST(end_ AS VARCHAR) AS end_, value FROM clean")
def drop_contradictions(spark, sf_dir):
    return _days(clean.drop_contradictions(adapter.facts(spark, sf_dir)).withColumnRenamed("end", "end_"))


@_query(_with(FACTS) + " SELECT adsh, tag, CASE WHEN start = end_ THEN abs(value) ELSE abs(value / greatest(datediff('day', start, end_), 90) * 90) END AS value_adj FROM facts")
def value_adj(spark, sf_dir):
    return adapter.facts(spark, sf_dir).select("adsh", "tag", scalars.value_adj(F.col("start"), F.col("end"), F.col("value")).alias("value_adj"))


@_query(_with(FACTS) + " SELECT adsh, tag, value * 1e8 AS value FROM facts WHERE value * 1e8 <= 5e12 OR tag IN ('NotionalAmountOfDerivatives', 'DerivativeNotionalAmount', 'DerivativeAssetNotionalAmount', 'DerivativeLiabilityNotionalAmount')")
def remove_huge_values(spark, sf_dir):
    return clean.remove_huge_values(clean.normalize_fact_types(adapter.facts(spark, sf_dir).withColumn("value", F.col("value") * 1e8))).select("adsh", "tag", "value")


@_query(
    _with(
        SUB, FACTS,
        "k AS (SELECT DISTINCT f.adsh, f.tag, f.start, f.end_, CAST(1000 + f.adsh % 20 AS DOUBLE) * CASE WHEN f.adsh % 97 = 0 THEN 1000 ELSE 1 END AS value, s.cik FROM facts f JOIN sub s ON f.adsh = s.adsh)",
        "a AS (SELECT *, CASE WHEN start = end_ THEN abs(value) ELSE abs(value / greatest(datediff('day', start, end_), 90) * 90) END AS adj FROM k)",
        "m AS (SELECT cik, tag, median(adj) AS med FROM a GROUP BY 1, 2)",
        """p AS (SELECT a.adsh, a.tag, a.start, a.end_,
          min(CASE WHEN a.value > m.med * 100 AND (a.value > y.adj * 965 AND a.value < y.adj * 1036) THEN 1
                   WHEN a.value > m.med * 10000 AND a.value > y.adj * 750000 AND a.value < y.adj * 1333000 THEN 2
                   WHEN a.value < m.med / 100 AND a.value > y.adj / 1036 AND a.value < y.adj / 965 THEN 3
                   WHEN a.value < m.med / 10000 AND a.value > y.adj / 1333000 AND a.value < y.adj / 750000 THEN 4 END) AS c
          FROM a JOIN m ON a.cik = m.cik AND a.tag = m.tag JOIN a y ON a.cik = y.cik AND a.tag = y.tag AND abs(datediff('day', a.end_, y.end_)) <= 120 GROUP BY ALL)""",
    )
    + " SELECT k.adsh, k.tag, CAST(k.start AS VARCHAR) AS start, CAST(k.end_ AS VARCHAR) AS end_, round(k.value * coalesce(CASE c WHEN 1 THEN 1e-3 WHEN 2 THEN 1e-6 WHEN 3 THEN 1e3 WHEN 4 THEN 1e6 END, 1), 2) AS value FROM k LEFT JOIN p ON k.adsh = p.adsh AND k.tag = p.tag AND k.start = p.start AND k.end_ = p.end_"
)
def correct_scale_outliers(spark, sf_dir):
    value = (1000 + F.col("adsh") % 20).cast("double") * F.when(F.col("adsh") % 97 == 0, 1000).otherwise(1)
    rows, _ = clean.correct_scale_outliers(clean.drop_contradictions(adapter.facts(spark, sf_dir).withColumn("value", value)), adapter.submissions(spark, sf_dir))
    return _rounded(_days(rows.withColumnRenamed("end", "end_")))


_SCALED = """
CASE WHEN a.value > m.med * 100 AND a.value > y.adj * 965 AND a.value < y.adj * 1036 THEN 1 WHEN a.value > m.med * 10000 AND a.value > y.adj * 750000 AND a.value < y.adj * 1333000 THEN 2
     WHEN a.value < m.med / 100 AND a.value > y.adj / 1036 AND a.value < y.adj / 965 THEN 3 WHEN a.value < m.med / 10000 AND a.value > y.adj / 1333000 AND a.value < y.adj / 750000 THEN 4 END"""
RESCALED_ALL = f"""
k AS (SELECT f.*, s.cik, CASE WHEN f.start = f.end_ THEN abs(f.value) ELSE abs(f.value / greatest(datediff('day', f.start, f.end_), 90) * 90) END AS adj FROM clean f JOIN sub s ON f.adsh = s.adsh),
m AS (SELECT cik, tag, median(adj) AS med FROM k GROUP BY 1, 2),
p AS (SELECT a.adsh, a.tag, a.start, a.end_, min({_SCALED}) AS c FROM k a JOIN m ON a.cik = m.cik AND a.tag = m.tag JOIN k y ON a.cik = y.cik AND a.tag = y.tag AND abs(datediff('day', a.end_, y.end_)) <= 120 GROUP BY ALL),
fixed AS (SELECT k.adsh, k.tag, k.start, k.end_, k.value * CASE c WHEN 1 THEN 1e-3 WHEN 2 THEN 1e-6 WHEN 3 THEN 1e3 WHEN 4 THEN 1e6 ELSE 1 END AS value FROM k LEFT JOIN p ON k.adsh = p.adsh AND k.tag = p.tag AND k.start = p.start AND k.end_ = p.end_)"""
_BASE = """ SELECT adsh, tag, round(value1, 2) AS reported_figure, round(value2, 2) AS quarterly_figure, round(value3, 2) AS reported_figure_py, round(value4, 2) AS quarterly_figure_py, false AS is_computed, false AS is_instant FROM d
        UNION ALL SELECT adsh, tag, round(value1, 2), round(value2, 2), round(value3, 2), round(value4, 2), false, true FROM i WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.adsh = i.adsh AND d.tag = i.tag)"""


# ---- windows and figures


@_query(_with(SUB, FACTS, _RAW_WINDOWS) + " SELECT adsh, CAST(start AS VARCHAR) AS start, CAST(end_ AS VARCHAR) AS end_, CAST(enum AS INT) AS enum FROM windows")
def infer_windows(spark, sf_dir):
    got = windows.infer_reporting_windows(adapter.facts(spark, sf_dir), adapter.submissions(spark, sf_dir))
    return _days(got.withColumnRenamed("end", "end_").withColumn("enum", F.col("enum").cast("int")))


@_query(_with(SUB, FACTS, _RAW_WINDOWS) + _PERIOD.format(facts="facts", where=""))
def period_values(spark, sf_dir):
    facts, sub = adapter.facts(spark, sf_dir), adapter.submissions(spark, sf_dir)
    return windows.compute_period_values(facts, sub, windows.infer_reporting_windows(facts, sub))[0]


@_query(_with(SUB, FACTS, _RAW_WINDOWS) + _INSTANT.format(facts="facts"))
def instant_values(spark, sf_dir):
    facts, sub = adapter.facts(spark, sf_dir), adapter.submissions(spark, sf_dir)
    return windows.compute_instant_values(clean.split_instant_duration(facts)[0], windows.infer_reporting_windows(facts, sub))


@_query(_with(FACTS) + " SELECT adsh, CAST(end_ AS VARCHAR) AS end_, count(*) AS n FROM facts WHERE year(end_) <= 2100 GROUP BY 1, 2")
def count_facts_per_end(spark, sf_dir):
    return _days(windows.count_facts_per_end(adapter.facts(spark, sf_dir)).withColumnRenamed("end", "end_"))


@_query(_with(SUB, FACTS, _RAW_WINDOWS) + " SELECT adsh, CAST(end_ AS VARCHAR) AS end_, 0 AS years_back FROM best UNION ALL SELECT adsh, CAST(end_ AS VARCHAR), 1 FROM best_py")
def best_end_per_filing(spark, sf_dir):
    facts, sub = adapter.facts(spark, sf_dir), adapter.submissions(spark, sf_dir)
    both = [windows.best_end_per_filing(facts, sub, years_back=k).withColumn("years_back", F.lit(k)) for k in (0, 1)]
    return _days(both[0].union(both[1]).withColumnRenamed("end", "end_"))


@_query(_with(SUB, FACTS, _RAW_WINDOWS) + " SELECT f.adsh, CAST(f.start AS VARCHAR) AS start, CAST(f.end_ AS VARCHAR) AS end_, count(*) AS n FROM facts f JOIN best b ON f.adsh = b.adsh AND f.end_ = b.end_ GROUP BY ALL")
def count_facts_per_range(spark, sf_dir):
    facts, sub = adapter.facts(spark, sf_dir), adapter.submissions(spark, sf_dir)
    return _days(windows.count_facts_per_range(facts, windows.best_end_per_filing(facts, sub)).withColumnRenamed("end", "end_"))


@_query(_with(SUB, FACTS, _RAW_WINDOWS) + " SELECT adsh, CAST(start AS VARCHAR) AS start, CAST(end_ AS VARCHAR) AS end_, CAST(enum AS INT) AS enum FROM windows")
def windows_step_by_step(spark, sf_dir):
    """infer_windows by rank_ranges and align_prior_year_ranges, which count the facts anew for each step."""
    facts, sub = cut(adapter.facts(spark, sf_dir)), adapter.submissions(spark, sf_dir)
    ranges = cut(windows.rank_ranges(facts, windows.best_end_per_filing(facts, sub)))
    both = ranges.unionByName(windows.align_prior_year_ranges(facts, windows.best_end_per_filing(facts, sub, years_back=1), ranges))
    return _days(both.withColumnRenamed("end", "end_").withColumn("enum", F.col("enum").cast("int")))


@_query(
    _with(SUB, FACTS, _RAW_WINDOWS)
    + " SELECT s.adsh, "
    + ", ".join(f"CAST(max(CASE WHEN enum = {k} THEN w.{c} END) AS VARCHAR) AS {c.strip('_')}_{n}" for k, n in ((1, "rep"), (2, "q"), (3, "rep_py"), (4, "q_py")) for c in ("start", "end_"))
    + " FROM sub s LEFT JOIN windows w ON s.adsh = w.adsh GROUP BY s.adsh"
)
def enrich_submissions(spark, sf_dir):
    facts, sub = adapter.facts(spark, sf_dir), adapter.submissions(spark, sf_dir)
    return _days(windows.enrich_sub_with_windows(sub.select("adsh"), windows.infer_reporting_windows(facts, sub)))


@_query(
    _with(SUB, FACTS, MERGED, CLEAN, _CLEAN_WINDOWS, "d AS (" + _PERIOD.format(facts="clean", where="WHERE f.start <> f.end_") + ")", "i AS (" + _INSTANT.format(facts="clean") + ")")
    + """ SELECT adsh, tag, value1 AS reported_figure, value2 AS quarterly_figure, value3 AS reported_figure_py, value4 AS quarterly_figure_py, false AS is_computed, false AS is_instant FROM d
        UNION ALL SELECT adsh, tag, value1, value2, value3, value4, false, true FROM i WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.adsh = i.adsh AND d.tag = i.tag)"""
)
def base_figures(spark, sf_dir):
    """Without the outlier loop, which SQL can't express; build_base_figures has it."""
    facts, sub = adapter.facts(spark, sf_dir), adapter.submissions(spark, sf_dir)
    rows = clean.remove_huge_values(clean.drop_contradictions(amendments.merge_amendments(cut(clean.normalize_fact_types(facts)), sub)))
    return figures.figures_from_clean(rows, sub)[0]


@_query(_with(SUB, FACTS, MERGED, CLEAN, RESCALED_ALL, WINDOWS.replace("{facts}", "fixed"), "d AS (" + _PERIOD.format(facts="fixed", where="WHERE f.start <> f.end_") + ")", "i AS (" + _INSTANT.format(facts="fixed") + ")") + _BASE)
def build_base_figures(spark, sf_dir):
    """The whole of it, with outliers corrected; these facts need one round, and the SQL has one."""
    return _rounded(figures.build_base_figures(adapter.facts(spark, sf_dir), adapter.submissions(spark, sf_dir))[0])


PLANTED = FACTS.replace("l.l_extendedprice AS value", "CAST(1000 + (l.l_orderkey + 1) % 20 AS DOUBLE) * CASE WHEN (l.l_orderkey + 1) % 97 = 0 THEN 1000 ELSE 1 END AS value")
RESCALED = """
k AS (SELECT f.*, s.cik, CASE WHEN f.start = f.end_ THEN abs(f.value) ELSE abs(f.value / greatest(datediff('day', f.start, f.end_), 90) * 90) END AS adj FROM clean f JOIN sub s ON f.adsh = s.adsh),
m AS (SELECT cik, tag, median(adj) AS med FROM k GROUP BY 1, 2),
p AS (
  SELECT a.adsh, a.tag, a.start, a.end_, min(CASE WHEN a.value > m.med * 100 AND a.value > y.adj * 965 AND a.value < y.adj * 1036 THEN 1 WHEN a.value < m.med / 100 AND a.value > y.adj / 1036 AND a.value < y.adj / 965 THEN 3 END) AS c
  FROM k a JOIN m ON a.cik = m.cik AND a.tag = m.tag JOIN k y ON a.cik = y.cik AND a.tag = y.tag AND abs(datediff('day', a.end_, y.end_)) <= 120 GROUP BY ALL),
fixed AS (SELECT k.adsh, k.tag, k.start, k.end_, round(k.value * CASE c WHEN 1 THEN 1e-3 WHEN 3 THEN 1e3 ELSE 1 END, 2) AS value FROM k LEFT JOIN p ON k.adsh = p.adsh AND k.tag = p.tag AND k.start = p.start AND k.end_ = p.end_)"""


@_query(
    _with(SUB, PLANTED, MERGED, CLEAN, RESCALED, WINDOWS.replace("{facts}", "fixed"), "d AS (" + _PERIOD.format(facts="fixed", where="WHERE f.start <> f.end_") + ")", "i AS (" + _INSTANT.format(facts="fixed") + ")")
    + """ SELECT adsh, tag, value1 AS reported_figure, value2 AS quarterly_figure, value3 AS reported_figure_py, value4 AS quarterly_figure_py, false AS is_computed, false AS is_instant FROM d
        UNION ALL SELECT adsh, tag, value1, value2, value3, value4, false, true FROM i WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.adsh = i.adsh AND d.tag = i.tag)"""
)
def build_base_figures_rescaled(spark, sf_dir):
    """The whole of it on facts of which 1 filing in 97 reports in thousands; one round puts right what has neighbours."""
    value = (1000 + F.col("adsh") % 20).cast("double") * F.when(F.col("adsh") % 97 == 0, 1000).otherwise(1)
    return _rounded(figures.build_base_figures(adapter.facts(spark, sf_dir).withColumn("value", value), adapter.submissions(spark, sf_dir))[0])


# ---- links

LINKED = """
sw AS (SELECT *, CAST(date_trunc('year', period) AS DATE) AS start_rep, period AS end_rep, CASE WHEN form LIKE '10-K%' THEN '10-K' ELSE '10-Q' END AS family FROM sub),
l10k AS (SELECT adsh, c_adsh AS prev_10k_adsh, lag_ AS prev_10k_diff_days FROM (
  SELECT a.adsh, b.adsh AS c_adsh, datediff('day', b.end_rep, a.end_rep) AS lag_, row_number() OVER (PARTITION BY a.adsh ORDER BY b.end_rep DESC, b.adsh DESC) AS rk
  FROM sw a JOIN sw b ON a.cik = b.cik WHERE b.form LIKE '10-K%' AND NOT b.is_amended AND datediff('day', b.end_rep, a.end_rep) BETWEEN 1 AND 375) WHERE rk = 1),
lpy AS (SELECT adsh, c_adsh AS adsh_py, off AS py_diff_days FROM (
  SELECT a.adsh, b.adsh AS c_adsh, abs(datediff('day', CAST(a.end_rep - INTERVAL 1 YEAR AS DATE), b.end_rep)) AS off,
         row_number() OVER (PARTITION BY a.adsh ORDER BY abs(datediff('day', CAST(a.end_rep - INTERVAL 1 YEAR AS DATE), b.end_rep)), b.end_rep DESC, b.adsh DESC) AS rk
  FROM sw a JOIN sw b ON a.cik = b.cik AND a.family = b.family WHERE NOT b.is_amended AND abs(datediff('day', CAST(a.end_rep - INTERVAL 1 YEAR AS DATE), b.end_rep)) <= 10) WHERE rk = 1),
lprev AS (SELECT adsh, c_adsh AS prev_adsh, c_form AS prev_form FROM (
  SELECT a.adsh, b.adsh AS c_adsh, b.form AS c_form, row_number() OVER (PARTITION BY a.adsh ORDER BY b.end_rep DESC, b.adsh DESC) AS rk
  FROM sw a JOIN sw b ON a.cik = b.cik AND a.start_rep = b.start_rep WHERE NOT b.is_amended AND b.end_rep < a.end_rep) WHERE rk = 1)"""


@_query(_with(SUB, LINKED) + " SELECT s.adsh, coalesce(prev_10k_adsh, 0) AS prev_10k_adsh, CAST(coalesce(prev_10k_diff_days, 0) AS INT) AS prev_10k_diff_days FROM sub s LEFT JOIN l10k USING (adsh)")
def prev_10k_link(spark, sf_dir):
    return links.prev_10k_link(adapter.sub_windows(spark, sf_dir)).withColumn("prev_10k_diff_days", F.col("prev_10k_diff_days").cast("int"))


@_query(_with(SUB, LINKED) + " SELECT s.adsh, coalesce(adsh_py, 0) AS adsh_py, CAST(coalesce(py_diff_days, 0) AS INT) AS py_diff_days FROM sub s LEFT JOIN lpy USING (adsh)")
def prior_year_link(spark, sf_dir):
    return links.prior_year_link(adapter.sub_windows(spark, sf_dir)).withColumn("py_diff_days", F.col("py_diff_days").cast("int"))


@_query(_with(SUB, LINKED) + " SELECT s.adsh, coalesce(prev_adsh, 0) AS prev_adsh, prev_form FROM sub s LEFT JOIN lprev USING (adsh)")
def prev_filing_link(spark, sf_dir):
    return links.prev_filing_link(adapter.sub_windows(spark, sf_dir))


# ---- derived figures

FIGURES = """
fig AS (
  SELECT adsh, tag, r AS reported_figure, CASE WHEN k % 3 = 0 THEN r END AS quarterly_figure, CASE WHEN k % 2 = 0 THEN r END AS reported_figure_py, CASE WHEN k % 4 = 0 THEN r END AS quarterly_figure_py, k = 7 AS is_instant
  FROM (SELECT l_orderkey + 1 AS adsh, p_type AS tag, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS r, max(l_linenumber) AS k FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2))"""
QUARTERLY = """
fq AS (
  SELECT f.* EXCLUDE (quarterly_figure, quarterly_figure_py),
    CASE WHEN f.is_instant THEN f.quarterly_figure ELSE coalesce(f.quarterly_figure, CASE WHEN l.prev_adsh IS NULL OR l.prev_form LIKE '10-K%' THEN f.reported_figure ELSE f.reported_figure - g.reported_figure END) END AS quarterly_figure,
    CASE WHEN f.is_instant THEN f.quarterly_figure_py ELSE coalesce(f.quarterly_figure_py, CASE WHEN l.prev_adsh IS NULL OR l.prev_form LIKE '10-K%' THEN f.reported_figure_py ELSE f.reported_figure_py - g.reported_figure_py END) END AS quarterly_figure_py
  FROM fig f LEFT JOIN lprev l ON f.adsh = l.adsh LEFT JOIN fig g ON g.adsh = l.prev_adsh AND g.tag = f.tag)"""
PRIOR = """
fp AS (
  SELECT f.* EXCLUDE (reported_figure_py, quarterly_figure_py), coalesce(f.reported_figure_py, g.reported_figure) AS reported_figure_py, coalesce(f.quarterly_figure_py, g.quarterly_figure) AS quarterly_figure_py
  FROM fq f LEFT JOIN lpy l ON f.adsh = l.adsh LEFT JOIN fq g ON g.adsh = l.adsh_py AND g.tag = f.tag)"""
ANNUAL = """
fa AS (
  SELECT f.*, CASE WHEN s.form LIKE '10-K%' THEN f.reported_figure WHEN NOT f.is_instant THEN f.reported_figure + g.reported_figure - f.reported_figure_py END AS annual_figure
  FROM fp f JOIN sub s ON f.adsh = s.adsh LEFT JOIN l10k l ON f.adsh = l.adsh LEFT JOIN fp g ON g.adsh = l.prev_10k_adsh AND g.tag = f.tag),
fb AS (SELECT f.*, g.annual_figure AS annual_figure_py FROM fa f LEFT JOIN lpy l ON f.adsh = l.adsh LEFT JOIN fa g ON g.adsh = l.adsh_py AND g.tag = f.tag)"""
_FOUR = ", ".join(f"round({c}, 2) AS {c}" for c in VALUES)


@_query(_with(SUB, LINKED, FIGURES, QUARTERLY) + f" SELECT adsh, tag, {_FOUR} FROM fq")
def fill_quarterly(spark, sf_dir):
    return _rounded(derive.fill_quarterly(adapter.link_figures(spark, sf_dir), adapter.sub_windows(spark, sf_dir)).select("adsh", "tag", *VALUES))


def _linked(spark, sf_dir):
    sub = adapter.sub_windows(spark, sf_dir)
    return adapter.link_figures(spark, sf_dir), sub, cut(links.all_links(sub))


def _through_prior(spark, sf_dir):
    """Figures at their companies with quarterly and prior-year figures filled; submissions; links."""
    rows, sub, found = _linked(spark, sf_dir)
    rows = derive.fill_quarterly(derive.gather_figures(rows, found), sub, check=False, links=found)
    return derive.fill_prior_year(rows, sub, links=found), sub, found


@_query(_with(SUB, LINKED, FIGURES, QUARTERLY, PRIOR) + f" SELECT adsh, tag, {_FOUR} FROM fp")
def fill_prior_year(spark, sf_dir):
    return _rounded(_through_prior(spark, sf_dir)[0].select("adsh", "tag", *VALUES))


@_query(_with(SUB, LINKED, FIGURES, QUARTERLY, PRIOR, ANNUAL) + " SELECT adsh, tag, round(annual_figure, 2) AS annual_figure FROM fa")
def annual_current(spark, sf_dir):
    rows, sub, found = _through_prior(spark, sf_dir)
    return _rounded(derive.annual_current(rows, sub, links=found).select("adsh", "tag", "annual_figure"))


@_query(_with(SUB, LINKED, FIGURES, QUARTERLY, PRIOR, ANNUAL) + " SELECT adsh, tag, round(annual_figure_py, 2) AS annual_figure_py FROM fb")
def annual_prior_year(spark, sf_dir):
    rows, sub, found = _linked(spark, sf_dir)
    return _rounded(derive.derive_figures(rows, sub, check=False, links=found).select("adsh", "tag", "annual_figure_py"))


@_query(_with(SUB, LINKED, FIGURES, QUARTERLY, PRIOR, ANNUAL) + " SELECT adsh, tag, round(annual_figure_py, 2) AS annual_figure_py FROM fb")
def annual_prior_year_step(spark, sf_dir):
    """The same by the four functions, one after another."""
    rows, sub, found = _through_prior(spark, sf_dir)
    rows = derive.annual_current(rows, sub, links=found)
    return _rounded(derive.annual_prior_year(rows, sub, links=found).select("adsh", "tag", "annual_figure_py"))


INTERVALS = """
s1 AS (
  SELECT s.*, CASE WHEN adsh % 3 = 0 THEN CAST(date_trunc('quarter', period) AS DATE) END AS start_q0, CASE WHEN adsh % 3 = 0 THEN period END AS end_q0, coalesce(CASE WHEN adsh % 3 = 0 THEN period END, end_rep) AS end_q, CAST(end_rep - INTERVAL 1 YEAR AS DATE) AS end_rep_py
  FROM sw s),
s2 AS (
  SELECT s1.adsh, coalesce(p.adsh_py, 0) AS adsh_py, s1.end_rep AS end_a, s1.end_rep_py AS end_a_py, CASE WHEN s1.form LIKE '10-K%' THEN s1.start_rep ELSE k.start_rep END AS start_a, y.start_rep AS start_a_py,
         coalesce(s1.start_q0, CASE WHEN v.prev_adsh IS NULL THEN s1.start_rep ELSE coalesce(b.end_q, b.end_rep) + 1 END) AS start_q, s1.end_q, s1.end_rep_py AS end_q_py
  FROM s1 LEFT JOIN l10k t ON s1.adsh = t.adsh LEFT JOIN s1 k ON k.adsh = t.prev_10k_adsh LEFT JOIN lpy p ON s1.adsh = p.adsh LEFT JOIN s1 y ON y.adsh = p.adsh_py LEFT JOIN lprev v ON s1.adsh = v.adsh LEFT JOIN s1 b ON b.adsh = v.prev_adsh)"""


def _interval_submissions(spark, sf_dir):
    third = lambda c: F.when(F.col("adsh") % 3 == 0, c)
    none = F.lit(None).cast("date")
    return adapter.sub_windows(spark, sf_dir).withColumns({"start_q": third(F.trunc("period", "quarter")), "end_q": third(F.col("period")), "start_rep_py": F.add_months("start_rep", -12), "end_rep_py": (F.col("end_rep") - F.expr("interval 1 year")).cast("date"), "start_q_py": none, "end_q_py": none})


@_query(
    _with(SUB, LINKED, INTERVALS)
    + " SELECT a.adsh, "
    + ", ".join(f"CAST(a.{c} AS VARCHAR) AS {c}" for c in ("start_a", "end_a", "start_a_py", "end_a_py", "start_q", "end_q", "end_q_py"))
    + ", CAST(b.start_q AS VARCHAR) AS start_q_py FROM s2 a LEFT JOIN s2 b ON b.adsh = a.adsh_py"
)
def impute_intervals(spark, sf_dir):
    got = derive.impute_intervals(_interval_submissions(spark, sf_dir))
    return _days(got.select("adsh", "start_a", "end_a", "start_a_py", "end_a_py", "start_q", "end_q", "start_q_py", "end_q_py"))


# ---- pivot

BY_PART = """
fpart AS (SELECT l_orderkey + 1 AS adsh, CAST(l_partkey AS VARCHAR) AS tag, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS reported_figure FROM lineitem GROUP BY 1, 2),
kept AS (SELECT tag FROM (SELECT tag, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, tag) - 1 AS rk FROM fpart GROUP BY tag) WHERE n > rk)"""


@_query(_with(BY_PART) + " SELECT adsh, tag, reported_figure FROM fpart WHERE tag IN (SELECT tag FROM kept) AND reported_figure IS NOT NULL")
def remove_infrequent_tags(spark, sf_dir):
    rows = adapter.table(spark, sf_dir, "lineitem").groupBy((F.col("l_orderkey") + 1).alias("adsh"), F.col("l_partkey").cast("string").alias("tag")).agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("reported_figure"))
    return pivot.remove_infrequent_tags(rows)


TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
_WIDE = ", ".join(f"max(CASE WHEN tag = '{t}' THEN round({c}, 2) END) AS {t}{s}" for t in TYPES for c, s in pivot.SUFFIXES.items())


@_query(_with(SUB, LINKED, FIGURES, QUARTERLY, PRIOR, ANNUAL) + f" SELECT fb.adsh, any_value(s.cik) AS cik, any_value(s.form) AS form, {_WIDE} FROM fb JOIN sub s ON fb.adsh = s.adsh GROUP BY fb.adsh")
def pivot_figures(spark, sf_dir):
    rows, sub, found = _linked(spark, sf_dir)
    rows = derive.derive_figures(rows, sub, check=False, links=found)
    return _rounded(pivot.pivot_figures(rows, sub.select("adsh", "cik", "form"), tags=list(TYPES)))


@_query(_with(SUB, LINKED, FIGURES, QUARTERLY, PRIOR, ANNUAL) + f" SELECT fb.adsh, any_value(s.cik) AS cik, any_value(CAST(s.period AS VARCHAR)) AS end_a, {_WIDE} FROM fb JOIN sub s ON fb.adsh = s.adsh GROUP BY fb.adsh")
def transform_and_pivot(spark, sf_dir):
    got = pivot.transform_and_pivot_figures(adapter.link_figures(spark, sf_dir), _interval_submissions(spark, sf_dir), tags=list(TYPES))
    return _rounded(_days(got)).select("adsh", "cik", "end_a", *[f"{t}{s}" for t in TYPES for s in pivot.SUFFIXES.values()])


# ---- equations

PRICES = """
price AS (SELECT o_orderkey + 1 AS adsh, CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS DOUBLE) AS c FROM orders),
vals AS (
  SELECT adsh, 'X' AS tag, c AS v FROM price UNION ALL SELECT adsh, 'Y', c * 2 FROM price UNION ALL SELECT adsh, 'Z', c * 4 FROM price
  UNION ALL SELECT adsh, 'XY', c * 3 FROM price WHERE adsh % 4 <> 0 UNION ALL SELECT adsh, 'GAP', c * CASE WHEN adsh % 4 = 1 THEN 5 ELSE 3 END FROM price)"""


@_query(_with(PRICES) + " SELECT adsh, tag, v AS reported_figure, false AS is_computed FROM vals UNION ALL SELECT adsh, 'XY', c * 3, true FROM price WHERE adsh % 4 = 0 UNION ALL SELECT adsh, 'ALL', c * 7, true FROM price")
def apply_arcs(spark, sf_dir):
    return arcs.apply_arcs(adapter.arc_figures(spark, sf_dir), adapter.arcs(spark)).select("adsh", "tag", "reported_figure", "is_computed")


@_query(_with(PRICES) + " SELECT adsh, tag, v AS reported_figure, false AS is_computed FROM vals UNION ALL SELECT adsh, 'XY', c * 3, true FROM price WHERE adsh % 4 = 0 UNION ALL SELECT adsh, 'ALL', c * 7, true FROM price")
def apply_arcs_by_version(spark, sf_dir):
    return arcs.apply_arcs_by_version(adapter.arc_figures(spark, sf_dir), adapter.arc_submissions(spark, sf_dir), adapter.arcs(spark)).select("adsh", "tag", "reported_figure", "is_computed")


@_query(_with(PRICES) + " SELECT 'soi' AS statement, 'XY' AS \"from\", CAST(2 AS BIGINT) AS n_terms, count(*) AS n_tests, CAST(0 AS BIGINT) AS n_fail, true AS kept FROM price WHERE adsh % 4 <> 0 UNION ALL SELECT 'sfp', 'GAP', 2, count(*), count(CASE WHEN adsh % 4 = 1 THEN 1 END), false FROM price")
def filter_unreliable_arcs(spark, sf_dir):
    rows, sub = adapter.arc_figures(spark, sf_dir), adapter.arc_submissions(spark, sf_dir)
    kept, stats = arcs.filter_unreliable_arcs(rows, sub, adapter.arcs(spark))
    return stats.join(kept.select("statement", "from").distinct().withColumn("kept", F.lit(True)), ["statement", "from"], "left").select("statement", "from", "n_terms", "n_tests", "n_fail", F.coalesce("kept", F.lit(False)).alias("kept"))


@_query(
    _with(PRICES)
    + """ SELECT adsh, tag, v AS reported_figure FROM vals UNION ALL SELECT adsh, 'XY', c * 3 FROM price WHERE adsh % 4 = 0"""
)
def compute_missing_with_arcs(spark, sf_dir):
    """Only X + Y = XY is reliable; solved for X and Y it adds nothing that is not there."""
    return arcs.compute_missing_with_arcs(adapter.arc_figures(spark, sf_dir), adapter.arc_submissions(spark, sf_dir), adapter.arcs(spark)).select("adsh", "tag", "reported_figure")


@_query(
    _with(PRICES)
    + """ SELECT adsh, tag, v AS reported_figure, false AS is_computed FROM vals
        UNION ALL SELECT adsh, 'XY', c * 3, true FROM price WHERE adsh % 4 = 0 AND adsh % 3 <> 2 UNION ALL SELECT adsh, 'ALL', c * 7, true FROM price WHERE adsh % 3 = 1
        UNION ALL SELECT adsh, 'PAIR', c * 5, true FROM price WHERE adsh % 3 = 0"""
)
def apply_arcs_by_two_versions(spark, sf_dir):
    """Filings of three years: two with equations of their own, one without any."""
    year = lambda v, **names: adapter.arcs(spark).withColumn("version", F.lit(v))
    pair = spark.createDataFrame([(2, "soi", 0, "XY", "X", 1.0), (2, "soi", 0, "XY", "Y", 1.0), (2, "soi", 0, "PAIR", "X", 1.0), (2, "soi", 0, "PAIR", "Z", 1.0)], "version int, statement string, seq int, `from` string, `to` string, weight double")
    sub = adapter.arc_submissions(spark, sf_dir).withColumn("version", F.when(F.col("adsh") % 3 == 1, 1).when(F.col("adsh") % 3 == 0, 2).otherwise(3))
    return arcs.apply_arcs_by_version(adapter.arc_figures(spark, sf_dir), sub, year(1).union(pair)).select("adsh", "tag", "reported_figure", "is_computed")


@_query(_with(PRICES) + """ SELECT adsh, tag, v AS reported_figure, tag = 'X' AND adsh % 9 = 0 AND adsh % 4 <> 0 AS is_computed FROM vals UNION ALL SELECT adsh, 'XY', c * 3, true FROM price WHERE adsh % 4 = 0""")
def compute_missing_solved(spark, sf_dir):
    """X is missing where X + Y = XY can be solved for it."""
    rows = adapter.arc_figures(spark, sf_dir).where(~((F.col("tag") == "X") & (F.col("adsh") % 9 == 0) & (F.col("adsh") % 4 != 0)))
    return arcs.compute_missing_with_arcs(rows, adapter.arc_submissions(spark, sf_dir), adapter.arcs(spark)).select("adsh", "tag", "reported_figure", "is_computed")


ARCS = """
arcs AS (SELECT DISTINCT CAST(p_size % 3 AS INT) AS version, 'soi' AS statement, 0 AS seq, p_brand AS f, p_type AS t FROM part),
w AS (SELECT *, CASE WHEN length(f || t) % 3 = 0 THEN -1.0 WHEN length(f || t) % 3 = 1 THEN 1.0 ELSE 2.0 END AS weight FROM arcs)"""
EXPANDED = (
    "x AS (SELECT version, statement, 1 AS seq, t AS f, f AS t, weight FROM w WHERE weight IN (1, -1) UNION ALL SELECT a.version, a.statement, 1, a.t, b.t, -b.weight / a.weight FROM w a JOIN w b ON a.version = b.version AND a.f = b.f AND a.t <> b.t WHERE a.weight IN (1, -1))",
    ' SELECT version, statement, seq, f AS "from", t AS "to", weight FROM w UNION ALL SELECT version, statement, seq, f, t, min(weight) FROM x GROUP BY ALL',
)


def _part_arcs(spark, sf_dir):
    n = F.length(F.concat("from", "to")) % 3
    rows = adapter.table(spark, sf_dir, "part").select((F.col("p_size") % 3).cast("int").alias("version"), F.lit("soi").alias("statement"), F.lit(0).alias("seq"), F.col("p_brand").alias("from"), F.col("p_type").alias("to")).distinct()
    return rows.withColumn("weight", F.when(n == 0, -1.0).when(n == 1, 1.0).otherwise(2.0))


@_query(_with(ARCS, EXPANDED[0]) + EXPANDED[1])
def expand_arcs(spark, sf_dir):
    return arcs.expand_arcs(_part_arcs(spark, sf_dir), enforce_signature_unique_seq=False)


SPREAD = """
g AS (SELECT version, statement, seq, f, t, weight FROM w UNION ALL SELECT version, statement, seq, f, t, min(weight) FROM x GROUP BY ALL),
eq AS (
  SELECT 0 AS round, version, statement, seq, f, array_to_string(list_sort(list(t)), '|') AS signature, seq AS spot FROM g GROUP BY version, statement, seq, f
  UNION ALL
  SELECT round + 1, version, statement, seq, f, signature, spot + bump FROM (
    SELECT *, max(bump) OVER () AS moved FROM (SELECT *, row_number() OVER (PARTITION BY version, statement, spot, signature ORDER BY f) - 1 AS bump FROM eq)) WHERE moved > 0),
last_ AS (SELECT * FROM eq WHERE round = (SELECT max(round) FROM eq)),
ranked AS (SELECT *, dense_rank() OVER (PARTITION BY version ORDER BY spot) - 1 AS rank FROM last_)"""


SPREAD_ARCS = "WITH RECURSIVE " + ",".join((ARCS, EXPANDED[0], SPREAD)).lstrip() + ' SELECT g.version, g.statement, CAST(r.rank AS INT) AS seq, g.f AS "from", g.t AS "to", g.weight FROM g JOIN ranked r USING (version, statement, seq, f)'


@_query(SPREAD_ARCS)
def expand_arcs_unique(spark, sf_dir):
    """With the signatures spread over seqs; the tests compare this with a plain loop, too."""
    return arcs.expand_arcs(_part_arcs(spark, sf_dir))


@_query(_with(ARCS, EXPANDED[0]) + EXPANDED[1])
def expand_arcs_whole(spark, sf_dir):
    """The name that expand_arcs on the whole table had while expand_arcs read a part of it; the same rows."""
    return arcs.expand_arcs(_part_arcs(spark, sf_dir), enforce_signature_unique_seq=False)


@_query(SPREAD_ARCS)
def expand_arcs_unique_whole(spark, sf_dir):
    """The name that expand_arcs_unique on the whole table had; the same rows."""
    return arcs.expand_arcs(_part_arcs(spark, sf_dir))


@_query("SELECT CAST(p_size % 3 AS INT) AS version, 'soi' AS statement, 0 AS seq, p_brand AS \"from\", array_to_string(list_sort(list(DISTINCT p_type)), '|') AS signature FROM part GROUP BY ALL")
def component_signature(spark, sf_dir):
    return arcs.component_signature(_part_arcs(spark, sf_dir)).withColumn("signature", F.array_join("signature", "|"))


@_query("SELECT CAST(p_size % 3 AS INT) AS version, p_brand AS \"from\", p_type AS \"to\", CAST(dense_rank() OVER (PARTITION BY p_size % 3 ORDER BY p_size) - 1 AS INT) AS seq FROM part")
def dense_renumber_seq(spark, sf_dir):
    rows = adapter.table(spark, sf_dir, "part").select((F.col("p_size") % 3).cast("int").alias("version"), F.col("p_brand").alias("from"), F.col("p_type").alias("to"), F.col("p_size").alias("seq"))
    return arcs.dense_renumber_seq(rows).select("version", "from", "to", "seq")


def _tree(spark, sf_dir):
    nation, region, customer = (adapter.table(spark, sf_dir, t) for t in ("nation", "region", "customer"))
    one = lambda df, a, b: df.select(F.lit(1).alias("version"), F.lit("soi").alias("statement"), a.alias("from"), b.alias("to"), F.lit(1.0).alias("weight")).distinct()
    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    return one(region, F.lit("W"), name("R", "r_regionkey")).union(one(nation, name("R", "n_regionkey"), name("N", "n_nationkey"))).union(one(customer, name("N", "c_nationkey"), name("C", "c_custkey")))


@_query("""
SELECT 'W' AS "from", 'R' || r_regionkey AS "to", 2 AS seq FROM region UNION ALL SELECT 'R' || n_regionkey, 'N' || n_nationkey, 1 FROM nation UNION ALL SELECT 'N' || c_nationkey, 'C' || c_custkey, 0 FROM customer""")
def arc_sequence(spark, sf_dir):
    return arcs.assign_arc_sequence(_tree(spark, sf_dir)).select("from", "to", "seq")


@_query('SELECT p_brand AS "from", p_type AS "to", count(*) AS n FROM part WHERE p_type IN (SELECT p_type FROM part WHERE p_size > 25) AND p_brand IN (SELECT p_brand FROM part WHERE p_size > 48) GROUP BY 1, 2')
def filter_arcs_to_universe(spark, sf_dir):
    part = adapter.table(spark, sf_dir, "part")
    universe = part.where("p_size > 25").select(F.col("p_type").alias("tag")).union(part.where("p_size > 48").select("p_brand"))
    return arcs.filter_arcs_to_universe(part.select(F.col("p_brand").alias("from"), F.col("p_type").alias("to")), universe).groupBy("from", "to").agg(F.count("*").alias("n"))


# ---- checks


@_query(
    _with(SUB)
    + """ SELECT count(*) AS n_rows, CAST(count_if(adsh >= 10000000000000000) AS BIGINT) AS adsh_too_large, CAST(0 AS BIGINT) AS sic_too_large, CAST(count_if(year(period) <= 1996 OR year(period) >= 2030) AS BIGINT) AS period_year, CAST(count_if(year(accepted) <= 1996 OR year(accepted) >= 2030) AS BIGINT) AS accepted_year,
         CAST(count_if(is_amended <> (amendment_adsh <> 0)) AS BIGINT) AS flag_without_link, CAST(count_if(version = 0) AS BIGINT) AS no_version, CAST(count_if(version <> 0 AND (version < 2008 OR version > year(accepted) + 3)) AS BIGINT) AS version_range, CAST(max(version) > greatest(max(year(accepted)), max(year(period))) + 2 AS BIGINT) AS version_ahead, CAST(count_if(form NOT IN ('10-Q', '10-K', '10-Q/A', '10-K/A')) AS BIGINT) AS form, CAST(count_if(period > CAST(accepted AS DATE)) AS BIGINT) AS period_after_acceptance FROM sub"""
)
def check_submissions(spark, sf_dir):
    return checks.submission_violations(adapter.submissions(spark, sf_dir).withColumn("sic", F.lit(0)), first_year=1996)


@_query(_with(SUB, FACTS) + " SELECT count(*) AS n_rows, CAST(count_if(start > end_) AS BIGINT) AS start_after_end, CAST(0 AS BIGINT) AS orphans, (SELECT count(*) FROM sub WHERE adsh NOT IN (SELECT adsh FROM facts)) AS empty_filings FROM facts")
def check_facts(spark, sf_dir):
    return checks.fact_violations(adapter.facts(spark, sf_dir), adapter.submissions(spark, sf_dir))


@_query("SELECT o_orderkey AS adsh, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS value FROM orders WHERE o_orderstatus <> 'F'")
def check_golden_rows(spark, sf_dir):
    value = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_totalprice"))
    rows = adapter.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("adsh"), value.alias("value"), "o_orderstatus")
    return checks.check_golden_rows(rows.where("o_orderstatus = 'F'").select("adsh", "value"), rows.select("adsh", "value"))


# ---- landed inputs, made of the driver's tables


def _accession():
    """Accession numbers with dashes."""
    return F.regexp_replace(scalars.long_to_accession(F.col("adsh")), r"^(\d{10})(\d{2})(\d{6})$", "$1-$2-$3")


@_query(_with(SUB, FACTS) + " SELECT f.adsh, f.tag, CAST(f.start AS VARCHAR) AS start, CAST(f.end_ AS VARCHAR) AS end_, f.value FROM facts f JOIN sub s ON f.adsh = s.adsh WHERE s.form IN ('10-Q', '10-K', '10-Q/A', '10-K/A')")
def company_facts(spark, sf_dir):
    """Facts written as one JSON document per company, and read back."""
    rows = adapter.facts(spark, sf_dir).join(adapter.submissions(spark, sf_dir).select("adsh", "cik", "form"), "adsh")
    item = F.struct(F.col("end").cast("string").alias("end"), _accession().alias("accn"), F.col("value").alias("val"), "form", F.when(F.col("start") != F.col("end"), F.col("start").cast("string")).alias("start"))
    unit = rows.groupBy("cik", "tag").agg(F.collect_list(item).alias("items")).select("cik", "tag", F.struct(F.create_map(F.lit("USD"), F.col("items")).alias("units")).alias("body"))
    docs = unit.groupBy("cik").agg(F.map_from_entries(F.collect_list(F.struct("tag", "body"))).alias("tags")).select(F.to_json(F.struct("cik", F.create_map(F.lit("us-gaap"), F.col("tags")).alias("facts"))).alias("content"))
    return _days(landed.parse_company_facts(docs).withColumnRenamed("end", "end_"))


@_query(_with(SUB) + " SELECT adsh, cik, CAST(0 AS BIGINT) AS sic, form, CAST(period AS VARCHAR) AS period, strftime(accepted, '%Y-%m-%d %H:%M:%S') AS accepted FROM sub")
def bulk_submissions(spark, sf_dir):
    """Filings written as one JSON document of parallel arrays per company, and read back."""
    rows = adapter.submissions(spark, sf_dir)
    each = F.struct(_accession().alias("a"), F.col("form").alias("f"), F.col("period").cast("string").alias("r"), F.date_format("accepted", "yyyy-MM-dd'T'HH:mm:ss'.000Z'").alias("t"))
    lists = rows.groupBy("cik").agg(F.collect_list(each).alias("e"))
    recent = F.struct(F.col("e.a").alias("accessionNumber"), F.col("e.f").alias("form"), F.col("e.r").alias("reportDate"), F.col("e.t").alias("acceptanceDateTime"), F.col("e.a").alias("primaryDocument"))
    docs = lists.select(F.to_json(F.struct(F.col("cik").cast("string").alias("cik"), F.lit("").alias("sic"), F.struct(recent.alias("recent")).alias("filings"))).alias("content"))
    return landed.parse_bulk_submissions(docs).select("adsh", "cik", "sic", "form", F.col("period").cast("string").alias("period"), F.date_format("accepted", "yyyy-MM-dd HH:mm:ss").alias("accepted"))


@_query(_with(SUB) + " SELECT adsh, cik, CAST(0 AS BIGINT) AS sic, form, CAST(period AS VARCHAR) AS period, version FROM sub")
def fsd_submissions(spark, sf_dir):
    sub = adapter.submissions(spark, sf_dir)
    text = sub.select(_accession().alias("adsh"), F.col("cik").cast("string").alias("cik"), F.lit(None).cast("string").alias("sic"), "form", F.date_format("period", "yyyyMMdd").alias("period"), F.col("accepted").cast("string").alias("accepted"), F.lit("x.xml").alias("instance"))
    num = sub.where("version <> 0").select(_accession().alias("adsh"), F.explode(F.array(F.concat(F.lit("us-gaap/"), F.col("version").cast("string")), F.lit("dei/2001"))).alias("version"))
    return landed.join_fsd(text, num).select("adsh", "cik", "sic", "form", F.col("period").cast("string").alias("period"), "version")


@_query("SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS year, CAST(quarter(o_orderdate) AS INT) AS quarter FROM orders")
def discover_periods(spark, sf_dir):
    link = F.concat(F.lit('<a href="/files/'), F.year("o_orderdate").cast("string"), F.lit("q"), F.quarter("o_orderdate").cast("string"), F.lit('.zip">'))
    return landed.discover_periods(adapter.table(spark, sf_dir, "orders").select(link.alias("html")))


@_query("SELECT min(c_name) AS ticker, c_nationkey AS cik FROM customer GROUP BY c_nationkey")
def ticker_map(spark, sf_dir):
    return landed.first_ticker(adapter.table(spark, sf_dir, "customer").select(F.col("c_name").alias("ticker"), F.col("c_nationkey").alias("cik")))


@_query("SELECT DISTINCT p_brand AS tag FROM part WHERE p_size % 2 = 0 UNION SELECT 'EntityCommonStockSharesOutstanding' UNION SELECT 'EntityPublicFloat'")
def tag_universe(spark, sf_dir):
    kind = F.when(F.col("p_size") % 2 == 0, "xbrli:monetaryItemType").otherwise("xbrli:stringItemType")
    return landed.tag_universe_of(adapter.table(spark, sf_dir, "part").select(F.col("p_brand").alias("name"), kind.alias("type"), F.lit(None).cast("string").alias("abstract")))


@_query("SELECT o_orderkey + 1 AS adsh, CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE CAST(year(o_orderdate) + 10 AS INT) END AS version FROM orders")
def scan_taxonomy_version(spark, sf_dir):
    text = F.when(F.col("o_orderkey") % 5 != 0, F.concat(F.lit("xmlns http://x/us-gaap/"), (F.year("o_orderdate") + 10).cast("string"), F.lit("-01-31 us-gaap/2099"))).otherwise("us-gaap/1999")
    docs = adapter.table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 1).alias("adsh"), text.alias("text"))
    return landed.scan_taxonomy_version(docs.select("adsh"), docs)


def _instances(spark, sf_dir):
    """(adsh, cik, content): line items written as one instance document per order, every third in a unit other than money."""
    rows = adapter.table(spark, sf_dir, "lineitem").join(adapter.table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(adapter.table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    tag = F.concat(F.lit("us-gaap:"), F.replace(F.col("p_type"), F.lit(" "), F.lit("")))
    fact = F.concat(F.lit("<"), tag, F.lit(' contextRef="c1" unitRef="'), F.when(F.col("l_linenumber") % 3 == 2, "kg").otherwise("usd"), F.lit('">'), F.col("l_extendedprice").cast("string"), F.lit("</"), tag, F.lit(">"))
    context = F.concat(F.lit('<context id="c1"><entity><identifier scheme="x">'), F.col("o_custkey").cast("string"), F.lit("</identifier></entity><period><instant>"), F.to_date("o_orderdate").cast("string"), F.lit("</instant></period></context>"))
    units = F.lit('<unit id="usd"><measure>iso4217:USD</measure></unit><unit id="kg"><measure>kg</measure></unit>')
    docs = rows.groupBy((F.col("l_orderkey") + 1).alias("adsh"), F.col("o_custkey").alias("cik"), context.alias("c")).agg(F.array_join(F.collect_list(fact), "\n").alias("f"))
    return docs.select("adsh", "cik", F.concat(F.lit("<xbrl>"), "c", units, "f", F.lit("</xbrl>")).alias("content"))


@_query("""
SELECT l_orderkey + 1 AS adsh, replace(p_type, ' ', '') AS tag, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS end_, l_extendedprice AS value
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE l_linenumber % 3 <> 2""")
def xbrl_instances(spark, sf_dir):
    """Line items written as one instance document per order, and read back; lines in a unit other than money go."""
    docs = _instances(spark, sf_dir)
    return landed.read_xbrl_instances(docs).select("adsh", "tag", F.col("end").cast("string").alias("end_"), "value")


@_query(_with(SUB, FACTS) + " SELECT adsh, 'no facts' AS what FROM sub WHERE adsh NOT IN (SELECT adsh FROM facts) UNION ALL SELECT DISTINCT adsh, 'no metadata' FROM facts WHERE adsh NOT IN (SELECT adsh FROM sub WHERE version <> 0)")
def missing_filings(spark, sf_dir):
    facts, sub = adapter.facts(spark, sf_dir), adapter.submissions(spark, sf_dir)
    return submissions.reports_without_facts(sub, facts).select("adsh", F.lit("no facts").alias("what")).union(submissions.missing_adsh(facts, sub.where("version <> 0")).select("adsh", F.lit("no metadata").alias("what")))


@_query(
    _with(SUB, FACTS, "k AS (SELECT * FROM sub0 WHERE version <> 0 OR adsh IN (SELECT adsh FROM facts))")
    + """ SELECT adsh, cik, version, CASE WHEN last_ <> adsh THEN last_ ELSE 0 END AS amendment_adsh, c_name AS ticker
        FROM (SELECT *, last_value(adsh) OVER (PARTITION BY cik, period ORDER BY accepted, adsh ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_ FROM k) JOIN customer ON cik = c_custkey"""
)
def combine_sources(spark, sf_dir):
    sub, facts = adapter.submissions(spark, sf_dir).select("adsh", "cik", "form", "period", "accepted", "version").withColumn("sic", F.lit(0)), adapter.facts(spark, sf_dir)
    bulk = sub.drop("version")
    tickers = adapter.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cik"), F.col("c_name").alias("ticker"))
    docs = sub.select("adsh", F.lit("no taxonomy").alias("text"))
    return submissions.combine_submission_sources(sub.where("version <> 0"), bulk.where("adsh % 2 = 0"), bulk, facts, tickers, docs).select("adsh", "cik", "version", "amendment_adsh", "ticker")


@_query("""
SELECT o_orderkey AS adsh, o_orderkey * 7 // 100000000 AS filer,
       CASE WHEN o_orderkey % 3 = 0 THEN 'd' || o_orderkey || '.xml' WHEN o_orderkey % 3 = 1 THEN 'd' || o_orderkey || '_htm.xml' ELSE 'd.htm' || o_orderkey || '_htm.xml' END AS file
FROM orders""")
def instance_names(spark, sf_dir):
    """Filer prefixes and instance documents of primary documents."""
    key = F.col("o_orderkey").cast("string")
    name = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("d"), key, F.lit(".xml"))).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("d"), key, F.lit(".htm"))).otherwise(F.concat(F.lit("d.htm"), key, F.lit(".htm")))
    return adapter.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("adsh"), scalars.filer_of(F.col("o_orderkey") * 7).alias("filer"), scalars.instance_file_name(name).alias("file"))


@_query("SELECT o_custkey * 100000000 + o_orderkey AS adsh, o_custkey AS cik FROM orders WHERE o_orderkey % 7 = 0")
def lookup_missing_submissions(spark, sf_dir):
    """Every seventh filing is missing and is found at the filer that its number names; one in two of the others is filed under another company."""
    rows = adapter.table(spark, sf_dir, "orders").select((F.col("o_custkey") * 100_000_000 + F.col("o_orderkey")).alias("adsh"), "o_custkey", "o_orderkey")
    metadata = rows.select("adsh", F.when((F.col("o_orderkey") % 7 != 0) & (F.col("o_orderkey") % 2 == 0), 0).otherwise(F.col("o_custkey")).alias("cik"))
    return landed.lookup_missing_submissions(rows.where("o_orderkey % 7 = 0").select("adsh"), metadata)


@_query("""
SELECT l_orderkey + 1 AS adsh, CASE WHEN l_orderkey % 2 = 0 THEN p_type ELSE replace(p_type, ' ', '') END AS tag, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS end_, l_extendedprice AS value
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE l_orderkey % 2 = 0 OR l_linenumber % 3 <> 2""")
def backfill_missing_facts(spark, sf_dir):
    """Facts of every second filing; those of the others come from their instance documents."""
    docs = _instances(spark, sf_dir)
    rows = adapter.table(spark, sf_dir, "lineitem").where("l_orderkey % 2 = 0").join(adapter.table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(adapter.table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    day = F.to_date("o_orderdate")
    have = rows.select((F.col("l_orderkey") + 1).alias("adsh"), F.col("p_type").alias("tag"), day.alias("start"), day.alias("end"), F.col("l_extendedprice").alias("value"))
    got = landed.backfill_missing_facts(have, docs.select("adsh", "cik"), docs.select("adsh", "content"))
    return got.select("adsh", "tag", F.col("end").cast("string").alias("end_"), "value")


# ---- landed documents in other writing


def _summaries(spark, sf_dir):
    """(adsh, content): filing summaries whose first input file is an exhibit; every fifth names another year's namespace than its instance document uses."""
    year = F.when(F.col("o_orderkey") % 5 == 0, "2022").otherwise("2023")
    content = F.concat(
        F.lit('<?xml version="1.0"?><FilingSummary><!-- <File doctype="10-K">no.htm</File> --><InputFiles><File doctype="EX-101">e.htm</File><File original="a &gt; b" doctype=\'10-K\'>d&amp;'), F.col("o_orderkey").cast("string"),
        F.lit('.htm</File><File doctype="10-Q">z.htm</File></InputFiles><BaseTaxonomies><BaseTaxonomy>http://fasb.org/us-gaap/'), year, F.lit("</BaseTaxonomy><BaseTaxonomy>http://fasb.org/srt/2023</BaseTaxonomy><BaseTaxonomy>http://xbrl.sec.gov/dei/2023</BaseTaxonomy></BaseTaxonomies></FilingSummary>"),
    )
    return adapter.table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 1).alias("adsh"), content.alias("content"))


@_query("SELECT o_orderkey + 1 AS adsh, 'd&' || o_orderkey || '.htm' AS file, 'http://fasb.org/us-gaap/' || CASE WHEN o_orderkey % 5 = 0 THEN '2022' ELSE '2023' END || '|http://xbrl.sec.gov/dei/2023' AS namespaces FROM orders")
def filing_summaries(spark, sf_dir):
    return landed.read_filing_summary(_summaries(spark, sf_dir)).withColumn("namespaces", F.array_join("namespaces", "|"))


def _foreign_instances(spark, sf_dir):
    """(adsh, cik, content): one instance document per order, under one of three prefixes.

    Of a document's lines, by their number modulo 4: 1 is a price in dollars, written as text, with a character reference or in a CDATA
    section; 2 a price per share, whose unit is a quotient; 3 is nil; 0 is another company's or in a namespace of the filer's own.
    """
    rows = adapter.table(spark, sf_dir, "lineitem").join(adapter.table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(adapter.table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    kind, price = F.col("l_linenumber") % 4, F.col("l_extendedprice").cast("string")
    prefix = F.element_at(F.array(F.lit("us-gaap"), F.lit("g"), F.lit("fin")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    name = F.concat(F.when((kind == 0) & (F.col("l_partkey") % 2 == 0), "own").otherwise(prefix), F.lit(":"), F.replace("p_type", F.lit(" "), F.lit("")))
    attributes = F.concat(F.lit(' decimals="-3" contextRef="'), F.when((kind == 0) & (F.col("l_partkey") % 2 == 1), "c2").otherwise("c1"), F.lit("\" unitRef = '"), F.when(kind == 2, "ps").otherwise("usd"), F.lit("'"))
    text = F.when(F.col("l_linenumber") == 1, F.concat(F.lit("&#32;"), price)).when(F.col("l_linenumber") == 5, F.concat(F.lit("<![CDATA["), price, F.lit("]]>"))).otherwise(price)
    fact = F.when(kind == 3, F.concat(F.lit("<"), name, attributes, F.lit(' xsi:nil="true"/>'))).otherwise(F.concat(F.lit("<"), name, attributes, F.lit(">"), text, F.lit("</"), name, F.lit(" >")))
    context = lambda id_, cik: F.concat(F.lit(f'<xbrli:context id="{id_}"><xbrli:entity><xbrli:identifier scheme="http://www.sec.gov/CIK">'), F.lpad(cik.cast("string"), 10, "0"), F.lit("</xbrli:identifier></xbrli:entity><xbrli:period><xbrli:startDate>2020-01-01</xbrli:startDate><xbrli:endDate>"), F.to_date("o_orderdate").cast("string"), F.lit("</xbrli:endDate></xbrli:period></xbrli:context>"))
    head = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?><xbrli:xbrl xmlns:xbrli="http://www.xbrl.org/2003/instance" xmlns:own="http://company.example/2023" xmlns:'), prefix, F.lit("='http://fasb.org/us-gaap/2023'>"), context("c1", F.col("o_custkey")), context("c2", F.col("o_custkey") + 1),
        F.lit('<xbrli:unit id="ps"><xbrli:divide><xbrli:unitNumerator><xbrli:measure>iso4217:USD</xbrli:measure></xbrli:unitNumerator><xbrli:unitDenominator><xbrli:measure>xbrli:shares</xbrli:measure></xbrli:unitDenominator></xbrli:divide></xbrli:unit><xbrli:unit id="usd"><xbrli:measure>iso4217:USD</xbrli:measure></xbrli:unit><!-- <'),
        prefix, F.lit(':Old contextRef="c1" unitRef="usd">1</x> -->'),
    )
    docs = rows.groupBy((F.col("l_orderkey") + 1).alias("adsh"), F.col("o_custkey").alias("cik"), head.alias("h")).agg(F.array_join(F.collect_list(fact), "\n").alias("f"))
    return docs.select("adsh", "cik", F.concat("h", "f", F.lit("</xbrli:xbrl>")).alias("content"))


@_query("""
SELECT l_orderkey + 1 AS adsh, replace(p_type, ' ', '') AS tag, '2020-01-01' AS start, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS end_, CASE WHEN l_linenumber % 4 = 1 THEN l_extendedprice ELSE 0.0 END AS value
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE l_linenumber % 4 IN (1, 3) AND o_orderkey % 5 <> 0""")
def xbrl_instances_foreign(spark, sf_dir):
    """Instance documents with prefixes of their own, quotients of units, nil facts and other companies' contexts, read by the namespaces of their filing summaries."""
    summaries = landed.read_filing_summary(_summaries(spark, sf_dir))
    return _days(landed.read_xbrl_instances(_foreign_instances(spark, sf_dir), summaries=summaries).withColumnRenamed("end", "end_"))


@_query("""
SELECT l_orderkey + 1 AS adsh, replace(p_type, ' ', '') AS tag, '2020-01-01' AS start, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS end_, CASE WHEN l_linenumber % 4 = 1 THEN l_extendedprice ELSE 0.0 END AS value
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE l_linenumber % 4 IN (1, 3)""")
def xbrl_instances_declared(spark, sf_dir):
    """The same without summaries: by the namespaces that the documents declare."""
    return _days(landed.read_xbrl_instances(_foreign_instances(spark, sf_dir)).withColumnRenamed("end", "end_"))


def _linkbases(spark, sf_dir):
    """(path, content): parts as calculation linkbases of three years and five statements: TOP over ALL and a brand, ALL over brands, brands over types."""
    part = adapter.table(spark, sf_dir, "part")
    statement = F.element_at(F.array(*[F.lit(x) for x in landed.STATEMENTS]), (F.col("p_size") % 5 + 1).cast("int"))
    year = (F.col("p_size") % 3 + 2021).cast("string")
    brand, kind = F.replace("p_brand", F.lit("#"), F.lit("")), F.replace("p_type", F.lit(" "), F.lit(""))
    arcs_ = F.array(*[F.struct(a.alias("a"), b.alias("b")) for a, b in ((F.lit("TOP"), F.lit("ALL")), (F.lit("TOP"), brand), (F.lit("ALL"), brand), (brand, kind))])
    rows = part.select(year.alias("year"), statement.alias("statement"), F.inline(arcs_)).distinct()
    weight = F.when(F.length(F.concat("a", "b")) % 2 == 0, "-1").otherwise("1.0")
    tag = F.when(F.col("year") == "2022", "link").otherwise("lb")
    arc = F.concat(F.lit("<"), tag, F.lit(':calculationArc xlink:type="arc" order="1" xlink:from="loc_'), F.col("a"), F.lit("\" weight='"), weight, F.lit("' xlink:to=\"http://fasb.org/us-gaap/role/statement/"), F.col("b"), F.lit('"/>'))
    docs = rows.groupBy("year", "statement").agg(F.array_join(F.collect_list(arc), "\n").alias("arcs"))
    nested = F.concat(F.lit('<lb:linkbase xmlns:lb="http://www.xbrl.org/2003/linkbase" xmlns:xlink="http://www.w3.org/1999/xlink"><lb:roleRef roleURI="r"/><lb:calculationLink xlink:role="r"><lb:loc xlink:label="x"/>'), "arcs", F.lit("</lb:calculationLink></lb:linkbase>"))
    flat = F.concat(F.lit('<link:linkbase xmlns:link="http://www.xbrl.org/2003/linkbase" xmlns:xlink="http://www.w3.org/1999/xlink">'), "arcs", F.lit("</link:linkbase>"))
    return docs.select(F.concat(F.lit("/landed/us-gaap-"), "year", F.lit("/stm/us-gaap-stm-"), "statement", F.lit("-cal-"), "year", F.lit(".xml")).alias("path"), F.when(F.col("year") == "2022", flat).otherwise(nested).alias("content"))


@_query("""
WITH p AS (SELECT DISTINCT CAST(p_size % 3 + 2021 AS INT) AS version, ['scf-indir', 'sfp-cls', 'soi', 'sheci', 'soc'][p_size % 5 + 1] AS statement, replace(p_brand, '#', '') AS b, replace(p_type, ' ', '') AS t FROM part),
a AS (SELECT version, statement, 2 AS seq, 'TOP' AS f, 'ALL' AS t FROM p UNION SELECT version, statement, 2, 'TOP', b FROM p UNION SELECT version, statement, 1, 'ALL', b FROM p UNION SELECT version, statement, 0, b, t FROM p)
SELECT version, statement, seq, f AS "from", t AS "to", CASE WHEN length(f || t) % 2 = 0 THEN -1.0 ELSE 1.0 END AS weight FROM a""")
def calculation_linkbases(spark, sf_dir):
    """Parts written as linkbases of three years and five statements, and read back in one plan, with seq."""
    return landed.calculation_arcs(_linkbases(spark, sf_dir))


HEIGHTS = """
e AS (SELECT DISTINCT CAST(p_partkey % 3 AS INT) AS version, 'S' || p_size AS f, 'S' || (p_size // 2) AS t FROM part UNION SELECT DISTINCT CAST(p_partkey % 3 AS INT), 'S' || p_size, 'S' || (p_size - 7) FROM part WHERE p_size > 7),
r AS (SELECT version, f AS node, 0 AS h FROM e UNION SELECT e.version, e.f, r.h + 1 FROM r JOIN e ON e.t = r.node AND e.version = r.version)"""


@_query("WITH RECURSIVE " + HEIGHTS.lstrip() + ' SELECT e.version, e.f AS "from", e.t AS "to", max(r.h) AS seq FROM e JOIN r ON r.version = e.version AND r.node = e.f GROUP BY ALL')
def arc_heights(spark, sf_dir):
    """Sequence of a graph with paths of unequal length: every size over its half and over the size seven below."""
    part = adapter.table(spark, sf_dir, "part")
    size = lambda c: F.concat(F.lit("S"), c.cast("string"))
    edge = lambda df, c: df.select((F.col("p_partkey") % 3).cast("int").alias("version"), size(F.col("p_size")).alias("from"), size(c).alias("to"))
    rows = edge(part, F.floor(F.col("p_size") / 2)).union(edge(part.where("p_size > 7"), F.col("p_size") - 7)).distinct()
    return arcs.assign_arc_sequence(rows)


def _quarter_lines(spark, sf_dir):
    """Lines (path, line) of the sub.txt and num.txt of all quarters; every eleventh filing is in the next quarter too, with another sic and year. Quarters differ in the order of columns."""
    sub = adapter.submissions(spark, sf_dir)
    twice = F.explode(F.when(F.col("adsh") % 11 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("late")
    rows = sub.select("*", twice).withColumn("day", F.add_months(F.to_date("accepted"), 3 * F.col("late")))
    rows = rows.withColumns({"q": F.concat(F.year("day").cast("string"), F.lit("q"), F.quarter("day").cast("string")), "swapped": F.quarter("day") % 2 == 0})
    tab = lambda *cols: F.concat_ws("\t", *cols)
    text = lambda c: F.col(c).cast("string")
    sic = F.when(F.col("late") == 1, "7").otherwise("")
    first = tab(_accession(), text("cik"), sic, F.col("form"), F.date_format("period", "yyyyMMdd"), text("accepted"), F.lit("x.xml"), F.lit("more"))
    second = tab(F.lit("more"), F.col("form"), _accession(), sic, text("cik"), F.date_format("period", "yyyyMMdd"), F.lit("x.xml"), text("accepted"))
    head = F.when(F.col("swapped"), "name\tform\tadsh\tsic\tcik\tperiod\tinstance\taccepted").otherwise("adsh\tcik\tsic\tform\tperiod\taccepted\tinstance\tname")
    at = lambda name: F.concat(F.lit("/landed/"), "q", F.lit(f"/{name}.txt")).alias("path")
    subs = rows.select(at("sub"), F.when(F.col("swapped"), second).otherwise(first).alias("line")).union(rows.select(at("sub"), head).distinct())
    version = F.concat(F.lit("us-gaap/"), (F.year("accepted") + 10 + F.col("late")).cast("string"))
    nums = rows.select(at("num"), F.explode(F.array(tab(_accession(), F.lit("Cash"), version), tab(_accession(), F.lit("Cash"), F.lit("dei/2001")))).alias("line")).union(rows.select(at("num"), F.lit("adsh\ttag\tversion")).distinct())
    return subs, nums


@_query(_with(SUB, "d AS (SELECT *, CASE WHEN adsh % 11 = 0 THEN 1 ELSE 0 END AS late, CAST(CAST(accepted AS DATE) + INTERVAL 3 MONTH AS DATE) AS later FROM sub)")
        + " SELECT adsh, cik, CASE WHEN late = 1 THEN CAST(7 AS BIGINT) ELSE 0 END AS sic, form, CAST(period AS VARCHAR) AS period, strftime(accepted, '%Y-%m-%d %H:%M:%S') AS accepted, CAST(year(accepted) + 10 + late AS INT) AS version, CASE WHEN late = 1 THEN year(later) || 'q' || quarter(later) ELSE year(accepted) || 'q' || quarter(accepted) END AS quarter FROM d")
def fsd_quarters(spark, sf_dir):
    """All quarters' files as one table of lines each; a filing in two quarters has the rows of the later one."""
    subs, nums = _quarter_lines(spark, sf_dir)
    got = landed.combine_quarters(landed.tsv_lines(subs, landed.SUB_TXT), landed.tsv_lines(nums, ("adsh", "version")))
    return got.select("adsh", "cik", "sic", "form", F.col("period").cast("string").alias("period"), F.date_format("accepted", "yyyy-MM-dd HH:mm:ss").alias("accepted"), "version", "quarter")


@_query("SELECT DISTINCT p_brand || '-' || p_type AS tag FROM part WHERE p_size % 4 IN (0, 1) UNION SELECT 'EntityCommonStockSharesOutstanding' UNION SELECT 'EntityPublicFloat'")
def schema_elements(spark, sf_dir):
    """Parts written as schema documents of three years, with abstract elements, elements of text and of shares, and read back."""
    kind = F.when(F.col("p_size") % 4 == 1, "xbrli:sharesItemType").when(F.col("p_size") % 4 == 2, "xbrli:stringItemType").otherwise("xbrli:monetaryItemType")
    element = F.concat(F.lit('<xsd:element id="x" name="'), "p_brand", F.lit("-"), "p_type", F.lit('" type="'), kind, F.lit('"'), F.when(F.col("p_size") % 4 == 3, " abstract='true'").otherwise(""), F.lit(' nillable="true"/>'))
    rows = adapter.table(spark, sf_dir, "part").select((F.col("p_partkey") % 3).alias("year"), element.alias("e")).distinct()
    docs = rows.groupBy("year").agg(F.array_join(F.collect_list("e"), "").alias("e")).select(F.concat(F.lit('<xsd:schema xmlns:xsd="http://www.w3.org/2001/XMLSchema"><xsd:import namespace="x"/>'), "e", F.lit("</xsd:schema>")).alias("content"))
    return landed.parse_tag_universe(docs)


# ---- reports and assertions

@_query(
    _with(
        SUB, PLANTED, CLEAN.replace("FROM merged", "FROM facts"),
        "k AS (SELECT f.*, s.cik, CASE WHEN f.start = f.end_ THEN abs(f.value) ELSE abs(f.value / greatest(datediff('day', f.start, f.end_), 90) * 90) END AS adj FROM clean f JOIN sub s ON f.adsh = s.adsh)",
        "m AS (SELECT cik, tag, median(adj) AS med FROM k GROUP BY 1, 2)",
        f"p AS (SELECT a.adsh, a.tag, a.start, a.end_, min({_SCALED}) AS c FROM k a JOIN m ON a.cik = m.cik AND a.tag = m.tag JOIN k y ON a.cik = y.cik AND a.tag = y.tag AND abs(datediff('day', a.end_, y.end_)) <= 120 GROUP BY ALL)",
    )
    + " SELECT count(c) AS corrections, CASE WHEN count(c) > 0 THEN 1 ELSE 0 END AS rounds, true AS settled FROM p"
)
def scale_corrections(spark, sf_dir):
    """How many values of facts of which 1 filing in 97 reports in thousands are rescaled, in how many rounds, and whether none was left."""
    value = (1000 + F.col("adsh") % 20).cast("double") * F.when(F.col("adsh") % 97 == 0, 1000).otherwise(1)
    _, n = clean.correct_scale_outliers(clean.drop_contradictions(adapter.facts(spark, sf_dir).withColumn("value", value)), adapter.submissions(spark, sf_dir))
    return spark.createDataFrame([(int(n), n.rounds, n.settled)], "corrections long, rounds int, settled boolean")


@_query(_with(SUB, LINKED, FIGURES) + " SELECT f.adsh, f.tag, f.reported_figure, coalesce(l.adsh_py, 0) AS adsh_py, g.reported_figure AS a_year_earlier FROM fig f LEFT JOIN lpy l ON f.adsh = l.adsh LEFT JOIN fig g ON g.adsh = l.adsh_py AND g.tag = f.tag")
def lookup_by_link(spark, sf_dir):
    """Each figure with that of the same tag in the filing a year earlier; a repeated (adsh, tag) would fail."""
    found = links.lookup_by_link(adapter.link_figures(spark, sf_dir), links.prior_year_link(adapter.sub_windows(spark, sf_dir)), "adsh_py", {"reported_figure": "a_year_earlier"})
    return found.select("adsh", "tag", "reported_figure", "adsh_py", "a_year_earlier")


@_query(
    _with(
        SUB, FACTS,
        """c AS (SELECT count(*) AS n, count_if(version = 0) AS none, count_if(version <> 0 AND (version < 2008 OR version > year(accepted) + 3)) AS range_, count_if(period > CAST(accepted AS DATE)) AS late,
               count_if(year(period) <= 1996 OR year(period) >= 2030) AS py, count_if(year(accepted) <= 1996 OR year(accepted) >= 2030) AS ay FROM sub)""",
        "f AS (SELECT count(*) AS n, count_if(start > end_) AS turned, (SELECT count(*) FROM sub WHERE adsh NOT IN (SELECT adsh FROM facts)) AS empty FROM facts)",
    )
    + """ SELECT none || ' rows: no_version' AS failure FROM c WHERE none > 0 UNION ALL SELECT range_ || ' rows: version_range' FROM c WHERE range_ > 0 UNION ALL SELECT late || ' rows: period_after_acceptance' FROM c WHERE late > 0
        UNION ALL SELECT py || ' rows: period_year' FROM c WHERE py > 0 UNION ALL SELECT ay || ' rows: accepted_year' FROM c WHERE ay > 0
        UNION ALL SELECT n || ' rows, more than 1000000000 expected' FROM f UNION ALL SELECT turned || ' rows start after their end' FROM f WHERE turned > 0 UNION ALL SELECT empty || ' filings have no facts' FROM f WHERE empty > 17"""
)
def check_all(spark, sf_dir):
    """Every rule that submissions and facts break, as check_all would raise them."""
    sub = adapter.submissions(spark, sf_dir).withColumns({"sic": F.lit(0).cast("long"), "ticker": F.lit("T")})
    failed = checks.all_failures(adapter.facts(spark, sf_dir), sub, submission_limits={"min_rows": 0, "first_year": 1996}, fact_limits={"min_rows": 10**9})
    return spark.createDataFrame([(x,) for x in failed], "failure string")


@_query(_with(SUB, LINKED, FIGURES, QUARTERLY, PRIOR, ANNUAL) + " SELECT adsh, tag || '_a' AS \"column\", round(annual_figure, 2) + 1 AS value FROM fb WHERE adsh % 2 = 0 AND annual_figure IS NOT NULL")
def check_pivot_values(spark, sf_dir):
    """Cells of the wide table that are not as expected: those of even filings are looked for with another value."""
    rows, sub, found = _linked(spark, sf_dir)
    rows = cut(derive.derive_figures(rows, sub, check=False, links=found).select("adsh", "tag", *pivot.SUFFIXES))
    wide = _rounded(pivot.pivot_figures(rows, sub.select("adsh"), tags=list(TYPES)))
    value = F.round("annual_figure", 2)
    cells = rows.where("annual_figure is not null").select("adsh", F.concat("tag", F.lit("_a")).alias("column"), F.when(F.col("adsh") % 2 == 0, value + 1).otherwise(value).alias("value"))
    return checks.missing_pivot_cells(wide, cells)


@_query(_with(SUB, LINKED, FIGURES, QUARTERLY, PRIOR, ANNUAL) + f" SELECT fb.adsh, any_value(s.cik) AS cik, {_WIDE} FROM fb JOIN sub s ON fb.adsh = s.adsh GROUP BY fb.adsh")
def pivot_discovered(spark, sf_dir):
    """The wide table with the tags that there are."""
    rows, sub, found = _linked(spark, sf_dir)
    return _rounded(pivot.pivot_figures(derive.derive_figures(rows, sub, check=False, links=found), sub.select("adsh", "cik")))


@_query(_with(SUB, LINKED, FIGURES, QUARTERLY, PRIOR, ANNUAL) + " SELECT fb.adsh, s.form, fb.tag, round(quarterly_figure, 2) AS q, round(quarterly_figure_py, 2) AS q_py, round(annual_figure, 2) AS a, round(annual_figure_py, 2) AS a_py FROM fb JOIN sub s ON fb.adsh = s.adsh")
def pivot_as_map(spark, sf_dir):
    """The wide table as one map per filing, and its entries."""
    rows, sub, found = _linked(spark, sf_dir)
    got = pivot.pivot_figures(derive.derive_figures(rows, sub, check=False, links=found), sub.select("adsh", "form"), as_map=True)
    return _rounded(got.select("adsh", "form", F.explode("figures").alias("tag", "f")).select("adsh", "form", "tag", "f.q", "f.q_py", "f.a", "f.a_py"))


@_query(
    _with(PRICES)
    + """ SELECT adsh, tag, v AS reported_figure, v + 1 AS reported_figure_py, false AS is_computed, false AS twice FROM vals UNION ALL SELECT adsh, 'SUM', c * 3, c * 3 + 2, true, false FROM price
        UNION ALL SELECT adsh, tag, v, v + 1, false, true FROM vals UNION ALL SELECT adsh, 'SUM', c * 6, c * 6 + 4, true, true FROM price"""
)
def apply_arcs_prior_year(spark, sf_dir):
    """Prior-year columns are summed too; an equation in two statements counts once or twice."""
    rows = adapter.arc_figures(spark, sf_dir).withColumn("reported_figure_py", F.col("reported_figure") + 1)
    both = spark.createDataFrame([(s, 0, "SUM", t, 1.0) for s in ("soi", "sfp") for t in ("X", "Y")], "statement string, seq int, `from` string, `to` string, weight double")
    run = lambda once: arcs.apply_arcs(rows, both, dedupe_across_statements=once).select("adsh", "tag", "reported_figure", "reported_figure_py", "is_computed", F.lit(not once).alias("twice"))
    return run(True).union(run(False))
