"""Small fixtures with exact expected cells."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import scalars
from ledgerloom.operators import amendments, arcs, checks, clean, derive, figures, links, pivot, submissions, windows
from ledgerloom.schemas import FACTS, VALUES, require_columns
from ledgerloom.sources import landed

D = date.fromisoformat
FIG = "adsh long, tag string, reported_figure double, quarterly_figure double, reported_figure_py double, quarterly_figure_py double, is_computed boolean, is_instant boolean"
LINK = "adsh long, cik long, form string, start_rep date, end_rep date, is_amended boolean"
ARCS = "version int, statement string, seq int, `from` string, `to` string, weight double"


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def facts(spark, *data):
    return spark.createDataFrame([(a, t, D(s), D(e), v) for a, t, s, e, v in data], FACTS)


def figs(spark, *data):
    return spark.createDataFrame([(a, t, *v, False, i) for a, t, v, i in data], FIG)


def links_sub(spark, *data):
    return spark.createDataFrame([(a, c, f, D(s), D(e), m) for a, c, f, s, e, m in data], LINK)


def test_require_columns_names_what_is_missing(spark):
    with pytest.raises(ValueError, match=r"\['b', 'c'\]"):
        require_columns(spark.range(1), ["c", "b", "id"])


def sub_amend(spark, *data):
    return spark.createDataFrame([(a, b, datetime.fromisoformat(t)) for a, b, t in data], "adsh long, amendment_adsh long, accepted timestamp_ntz")


def test_canonical_map_follows_chains_and_ends_in_cycles(spark):
    sub = sub_amend(spark, (1, 2, "2023-01-01"), (2, 3, "2023-01-02"), (3, 0, "2023-01-03"))
    assert rows(amendments.canonical_adsh_map(sub)) == [(1, 3), (2, 3), (3, 3)]
    loop = sub_amend(spark, (1, 2, "2023-01-01"), (2, 1, "2023-01-02"))
    assert {r[1] for r in rows(amendments.canonical_adsh_map(loop))} <= {1, 2}


def test_apply_canonical_keeps_unknown(spark):
    mapping = spark.createDataFrame([(1, 3)], "adsh_original long, adsh_canonical long")
    got = amendments.apply_canonical_adsh(facts(spark, (1, "A", "2023-01-01", "2023-03-31", 1.0), (9, "A", "2023-01-01", "2023-03-31", 2.0)), mapping)
    assert rows(got, "adsh") == [(3,), (9,)]


def test_dedupe_latest(spark):
    f = facts(spark, (3, "A", "2023-01-01", "2023-03-31", 10.0), (3, "A", "2023-01-01", "2023-03-31", 11.0))
    assert rows(amendments.dedupe_latest_by_acceptance(f, sub_amend(spark, (3, 0, "2023-01-01"))), "value") == [(10.0,)]


def test_merge_amendments(spark):
    k = ("2023-01-01", "2023-03-31")
    f = facts(spark, (1, "Revenue", *k, 100.0), (1, "CostOfRevenue", *k, 60.0), (2, "Revenue", *k, 120.0))
    sub = sub_amend(spark, (1, 2, "2023-04-01"), (2, 0, "2023-05-01"))
    merged = amendments.merge_amendments(f, sub)
    want = [(1, "CostOfRevenue", 60.0), (1, "Revenue", 100.0), (2, "CostOfRevenue", 60.0), (2, "Revenue", 120.0)]
    assert rows(merged, "adsh", "tag", "value") == want
    assert rows(amendments.merge_amendments(merged, sub), "adsh", "tag", "value") == want


def test_merge_amendments_chain_and_earliest_source(spark):
    k = ("2023-01-01", "2023-03-31")
    f = facts(spark, (1, "A", *k, 1.0), (2, "B", *k, 2.0), (3, "C", *k, 3.0), (4, "A", *k, 9.0))
    sub = sub_amend(spark, (1, 2, "2023-04-01"), (2, 3, "2023-05-01"), (4, 3, "2023-04-20"), (3, 0, "2023-06-01"))
    got = {(a, t): v for a, t, v in rows(amendments.merge_amendments(f, sub), "adsh", "tag", "value")}
    assert got[(2, "A")] == 1.0 and got[(3, "B")] == 2.0 and got[(3, "A")] in (1.0, 9.0)


def test_merge_amendments_long_chain(spark):
    k, n = ("2023-01-01", "2023-03-31"), 25
    f = facts(spark, *[(i, f"T{i}", *k, float(i)) for i in range(1, n + 1)])
    sub = sub_amend(spark, *[(i, i + 1 if i < n else 0, "2023-04-01") for i in range(1, n + 1)])
    got = amendments.merge_amendments(f, sub).where(f"adsh = {n}")
    assert rows(got, "tag", "value") == sorted((f"T{i}", float(i)) for i in range(1, n + 1))


def test_merge_amendments_cycle(spark):
    k = ("2023-01-01", "2023-03-31")
    f = facts(spark, *[(i, f"T{i}", *k, float(i)) for i in range(1, 6)])
    sub = sub_amend(spark, (1, 2, "2023-04-01"), (2, 3, "2023-04-01"), (3, 1, "2023-04-01"), (3, 4, "2023-04-01"), (4, 5, "2023-04-01"), (5, 0, "2023-04-01"))
    got = rows(amendments.merge_amendments(f, sub), "adsh", "tag")
    assert got == sorted((a, f"T{t}") for a in range(1, 6) for t in range(1, 6) if t <= max(a, 3))


def test_flags_and_version_repair(spark):
    data = [(1, 7, "10-K", D("2022-12-31"), "2023-02-01", 2022), (2, 7, "10-K/A", D("2022-12-31"), "2023-03-01", 0), (3, 7, "10-Q", D("2023-03-31"), "2023-04-01", 0), (4, 8, "10-Q", D("2023-03-31"), "2023-04-01", 0), (5, 8, "10-Q", D("2023-06-30"), "2023-07-01", 2023), (6, 9, "10-Q", D("2023-06-30"), "2023-07-01", 0)]
    sub = spark.createDataFrame([(a, c, f, p, datetime.fromisoformat(t), v) for a, c, f, p, t, v in data], "adsh long, cik long, form string, period date, accepted timestamp_ntz, version int")
    flagged = submissions.amendment_flags(sub)
    assert rows(flagged, "adsh", "amendment_adsh", "is_amended")[:3] == [(1, 2, True), (2, 0, False), (3, 0, False)]
    assert rows(submissions.repair_version(flagged), "adsh", "version") == [(1, 2022), (2, 2022), (3, 2022), (4, 2023), (5, 2023), (6, 0)]


def test_value_adj(spark):
    f = facts(spark, (1, "A", "2023-01-01", "2023-12-31", 365.0), (1, "B", "2023-12-31", "2023-12-31", -50.0))
    got = rows(f.select(scalars.value_adj(F.col("start"), F.col("end"), F.col("value"))))
    assert got[0][0] == 50.0 or got[1][0] == 50.0
    assert any(abs(x[0] - 90.24725274725274) < 1e-9 for x in got)


def test_contradictions_and_huge(spark):
    k = ("2023-01-01", "2023-03-31")
    f = facts(spark, (1, "Revenue", *k, 10.0), (1, "Revenue", *k, 11.0), (1, "Cost", *k, 5.0), (1, "Cost", *k, 5.0), (1, "DerivativeNotionalAmount", *k, 5e13), (1, "Big", *k, 5e13), (1, "Null", *k, None), (1, "Half", *k, None), (1, "Half", *k, 1.0))
    once = clean.drop_contradictions(f)
    assert rows(once, "tag") == [("Big",), ("Cost",), ("DerivativeNotionalAmount",), ("Null",)]
    assert rows(clean.drop_contradictions(once), "tag") == rows(once, "tag")
    assert rows(clean.remove_huge_values(once), "tag") == [("Cost",), ("DerivativeNotionalAmount",)]


@pytest.mark.parametrize(("factor", "back"), [(1e3, 1e-3), (1e6, 1e-6), (1e-3, 1e3), (1e-6, 1e6)])
def test_scale_outliers_are_put_right_and_stay_so(spark, factor, back):
    ends = ["2022-03-31", "2022-06-30", "2022-09-30", "2022-12-31", "2023-03-31"]
    f = facts(spark, *[(i, "Cash", e, e, (1000.0 + i) * (factor if i == 2 else 1)) for i, e in enumerate(ends)])
    sub = spark.createDataFrame([(i, 1) for i in range(5)], "adsh long, cik long")
    fixed, n = clean.correct_scale_outliers(f, sub)
    assert n == 1 and all(900 < v < 1100 for (v,) in rows(fixed, "value"))
    again, n = clean.correct_scale_outliers(fixed, sub)
    assert n == 0 and rows(again, "adsh", "value") == rows(fixed, "adsh", "value")


def test_corrected_neighbours_bring_out_more_outliers(spark):
    """Each value but the first is too large and near the one before only, so every round puts one right."""
    ends = [*[f"20{y}-06-30" for y in range(10, 18)], "2022-01-01", "2022-04-11", "2022-07-20", "2022-10-28"]
    f = facts(spark, *[(i, "Cash", e, e, 1000.0 * (1000 if i > 8 else 1)) for i, e in enumerate(ends)])
    fixed, n = clean.correct_scale_outliers(f, spark.createDataFrame([(i, 1) for i in range(12)], "adsh long, cik long"))
    assert (n, n.rounds, n.settled) == (3, 3, True) and {v for (v,) in rows(fixed, "value")} == {1000.0}


def test_single_row_is_no_outlier(spark):
    f = facts(spark, (1, "A", "2023-01-01", "2023-03-31", 1.0))
    fixed, n = clean.correct_scale_outliers(f, spark.createDataFrame([(1, 1)], "adsh long, cik long"))
    assert n == 0 and fixed.count() == 1


def test_windows(spark):
    ytd, quarter, py, py_q = ("2024-01-01", "2024-06-30"), ("2024-04-01", "2024-06-30"), ("2023-01-01", "2023-06-30"), ("2023-04-01", "2023-06-30")
    f = facts(spark, *[(1, t, *w, v) for t, v in (("A", 1.0), ("B", 2.0)) for w in (ytd, quarter, py, py_q)], (1, "C", "2023-03-01", "2024-06-30", 9.0), (1, "Cash", "2024-06-30", "2024-06-30", 5.0), (1, "Only", *quarter, 3.0))
    sub = spark.createDataFrame([(1, 1, D("2024-06-30"))], "adsh long, cik long, period date")
    w = windows.infer_reporting_windows(f, sub)
    assert rows(w, "enum", "start") == [(1, D("2024-01-01")), (2, D("2024-04-01")), (3, D("2023-01-01")), (4, D("2023-04-01"))]
    values, enriched = windows.compute_period_values(f, sub, w)
    assert rows(values) == [(1, "A", 1.0, 1.0, 1.0, 1.0), (1, "B", 2.0, 2.0, 2.0, 2.0)]
    assert enriched.first()["end_q_py"] == D("2023-06-30")
    shuffled = windows.infer_reporting_windows(f.orderBy(F.rand(3)), sub)
    assert rows(shuffled) == rows(w)


def test_second_range_needs_its_share_and_leap_day(spark):
    f = facts(spark, *[(1, f"T{i}", "2023-03-01", "2024-02-29", 1.0) for i in range(10)], (1, "X", "2023-12-01", "2024-02-29", 1.0), *[(1, f"T{i}", "2022-03-01", "2023-02-28", 1.0) for i in range(3)])
    w = windows.infer_reporting_windows(f, spark.createDataFrame([(1, D("2024-02-29"))], "adsh long, period date"))
    assert rows(w, "enum", "start", "end") == [(1, D("2023-03-01"), D("2024-02-29")), (3, D("2022-03-01"), D("2023-02-28"))]


def test_no_overlap_gives_an_empty_typed_frame(spark):
    w = spark.createDataFrame([(1, 1, D("2022-01-01"), D("2022-12-31"))], "adsh long, enum tinyint, start date, end date")
    values, enriched = windows.compute_period_values(facts(spark, (1, "A", "2023-01-01", "2023-12-31", 1.0)), spark.createDataFrame([(1,)], "adsh long"), w)
    assert values.count() == 0 and "start_rep" in enriched.columns


def test_instants(spark):
    w = spark.createDataFrame([(1, 1, D("2023-01-01"), D("2023-12-31")), (1, 3, D("2022-01-01"), D("2022-12-31"))], "adsh long, enum tinyint, start date, end date")
    f = facts(spark, (1, "Cash", "2023-12-31", "2023-12-31", 50.0), (1, "Cash", "2022-12-31", "2022-12-31", 40.0), (1, "Old", "2020-12-31", "2020-12-31", 1.0))
    assert rows(windows.compute_instant_values(f, w)) == [(1, "Cash", 50.0, None, 40.0, None), (1, "Old", None, None, None, None)]


def test_links(spark):
    sub = links_sub(spark, (1, 1, "10-K/A", "2022-01-01", "2022-12-31", True), (2, 1, "10-K", "2023-01-01", "2023-12-31", False), (3, 1, "10-Q", "2024-01-01", "2024-03-31", False), (11, 1, "10-Q", "2023-01-01", "2023-03-31", False))
    assert (3, 2, 91) in rows(links.prev_10k_link(sub))
    assert (1, 0, 0) in rows(links.prev_10k_link(sub))
    assert (3, 11, 0) in rows(links.prior_year_link(sub))
    q = links_sub(spark, (100, 1, "10-Q", "2023-01-01", "2023-03-31", False), (101, 1, "10-Q", "2023-01-01", "2023-06-30", False), (102, 1, "10-Q", "2023-01-01", "2023-09-30", False))
    assert rows(links.prev_filing_link(q)) == [(100, 0, None), (101, 100, "10-Q"), (102, 101, "10-Q")]


def test_fill_quarterly(spark):
    sub = links_sub(spark, (1, 1, "10-Q", "2023-01-01", "2023-03-31", False), (2, 1, "10-Q", "2023-01-01", "2023-06-30", False))
    f = figs(spark, (1, "R", (30.0, 30.0, 20.0, None), False), (2, "R", (70.0, None, 40.0, None), False), (2, "Cash", (5.0, None, None, None), True))
    assert rows(derive.fill_quarterly(f, sub), "adsh", "tag", "quarterly_figure", "quarterly_figure_py") == [(1, "R", 30.0, 20.0), (2, "Cash", None, None), (2, "R", 40.0, 20.0)]
    with pytest.raises(ValueError, match="unknown"):
        derive.fill_quarterly(figs(spark, (9, "R", (1.0, None, None, None), False)), sub)


def test_fill_prior_year_and_annual(spark):
    sub = links_sub(spark, (10, 1, "10-Q", "2023-01-01", "2023-03-31", False), (20, 1, "10-Q", "2024-01-01", "2024-03-31", False))
    f = figs(spark, (10, "R", (30.0, 30.0, None, None), False), (20, "R", (40.0, 40.0, None, None), False))
    assert (20, 30.0, 30.0) in rows(derive.fill_prior_year(f, sub), "adsh", "reported_figure_py", "quarterly_figure_py")
    sub = links_sub(spark, (1, 1, "10-K", "2022-01-01", "2022-12-31", False), (2, 1, "10-Q", "2023-01-01", "2023-03-31", False), (3, 1, "10-Q", "2024-01-01", "2024-03-31", False))
    f = figs(spark, (1, "R", (100.0, None, None, None), False), (2, "R", (40.0, None, 20.0, None), False), (3, "R", (50.0, None, 40.0, None), False), (1, "Cash", (100.0, None, None, None), True), (2, "Cash", (9.0, None, None, None), True))
    now = derive.annual_current(f, sub)
    assert rows(now.where("adsh < 3"), "adsh", "tag", "annual_figure") == [(1, "Cash", 100.0), (1, "R", 100.0), (2, "Cash", None), (2, "R", 120.0)]
    assert (3, "R", 120.0) in rows(derive.annual_prior_year(now, sub), "adsh", "tag", "annual_figure_py")


def full_sub(spark):
    cols = "adsh long, cik long, form string, start_rep date, end_rep date, start_rep_py date, end_rep_py date, start_q date, end_q date, start_q_py date, end_q_py date, is_amended boolean"
    none = (None,) * 4
    data = [(1, 1, "10-K", D("2022-01-01"), D("2022-12-31"), None, None, *none, False), (2, 1, "10-Q", D("2023-01-01"), D("2023-03-31"), None, None, *none, False), (3, 1, "10-Q", D("2023-01-01"), D("2023-06-30"), None, None, *none, False), (4, 1, "10-Q", D("2024-01-01"), D("2024-03-31"), D("2023-01-01"), D("2023-03-31"), *none, False)]
    return spark.createDataFrame(data, cols)


def test_intervals(spark):
    got = {r["adsh"]: r for r in derive.impute_intervals(full_sub(spark)).collect()}
    assert got[2]["start_a"] == D("2022-01-01") and got[3]["start_q"] == D("2023-04-01") and got[4]["start_q_py"] == D("2023-01-01") and got[4]["end_q_py"] == D("2023-03-31")
    assert "start_rep" not in got[2].asDict()


def test_pivot_whole_and_as_map(spark):
    f = figs(spark, (1, "Revenue", (100.0, None, None, None), False), (2, "Revenue", (40.0, None, 20.0, None), False), (3, "Revenue", (70.0, None, None, None), False))
    wide = pivot.transform_and_pivot_figures(f, full_sub(spark))
    assert {"Revenue_q", "Revenue_q_py", "Revenue_a", "Revenue_a_py", "form", "start_a"} <= set(wide.columns) and "start_rep" not in wide.columns
    assert rows(wide, "adsh", "Revenue_q", "Revenue_a")[1] == (2, 40.0, 120.0)
    as_map = pivot.transform_and_pivot_figures(f, full_sub(spark), as_map=True)
    assert {r["adsh"]: r["figures"]["Revenue"]["a"] for r in as_map.collect()}[2] == 120.0


def test_infrequent_tags(spark):
    f = figs(spark, *[(i, "A", (1.0, None, None, None), False) for i in range(3)], *[(i, "B", (1.0, None, None, None), False) for i in range(2)], (1, "C", (1.0, None, None, None), False), (1, "Z", (None, None, None, None), False))
    assert {t for (t,) in rows(pivot.remove_infrequent_tags(f), "tag")} == {"A", "B"}


def test_apply_arcs(spark):
    a = spark.createDataFrame([(2022, "soi", 0, "A", "B", 1.0), (2022, "soi", 0, "A", "C", 1.0)], ARCS)
    none = (None, None, None)
    f = figs(spark, (1, "B", (40.0, *none), True), (1, "C", (60.0, *none), True), (1, "A", (None, *none), True))
    top = lambda df: [r for r in rows(df, "tag", "reported_figure", "is_computed") if r[0] == "A"]
    assert top(arcs.apply_arcs(f, a, keep_original_first=False)) == [("A", 100.0, True)]
    assert top(arcs.apply_arcs(f, a)) == [("A", None, False)]
    f = figs(spark, (1, "B", (40.0, *none), True), (1, "C", (60.0, *none), True), (1, "A", (999.0, *none), True))
    assert top(arcs.apply_arcs(f, a)) == [("A", 999.0, False)]
    twice = a.union(spark.createDataFrame([(2022, "sfp", 0, "A", "B", 1.0)], ARCS))
    f = f.where("tag <> 'A'")
    assert top(arcs.apply_arcs(f, twice)) == [("A", 140.0, True)]
    assert top(arcs.apply_arcs(f, twice, dedupe_across_statements=True)) == [("A", 100.0, True)]


def test_apply_arcs_by_version(spark):
    a = spark.createDataFrame([(2022, "soi", 0, "A", "B", 1.0), (2022, "soi", 0, "A", "C", 1.0), (2023, "soi", 0, "D", "B", 1.0), (2023, "soi", 0, "D", "C", 1.0)], ARCS)
    none = (None, None, None)
    f = figs(spark, *[(i, t, (v, *none), i == 1) for i in (1, 2, 3) for t, v in (("B", 1.0), ("C", 2.0))])
    sub = spark.createDataFrame([(1, 2022), (2, 2023)], "adsh long, version int")
    got = arcs.apply_arcs_by_version(f, sub, a).where("is_computed")
    assert rows(got, "adsh", "tag", "reported_figure", "is_instant") == [(1, "A", 3.0, True), (2, "D", 3.0, False)]


def test_tasks_of_equations_are_bounded(spark, monkeypatch):
    """More figures, more partitions; versions join them there; the same rows."""
    a = spark.createDataFrame([(2022, "soi", 0, "A", "B", 1.0), (2022, "soi", 1, "T", "A", 1.0), (2022, "soi", 1, "T", "B", 1.0)], ARCS)
    f = figs(spark, *[(i, "B", (float(i), None, None, None), False) for i in range(100)])
    sub = f.select("adsh").withColumn("version", F.lit(2022))
    run = lambda: (arcs.apply_arcs(f, a), arcs.apply_arcs_by_version(f, sub, a))
    whole = [rows(x) for x in run()]
    assert [len(x) for x in whole] == [300, 300]
    monkeypatch.setattr(arcs, "FIGURES_A_TASK", 10)
    assert [x.rdd.getNumPartitions() for x in run()] == [10, 10]
    assert [rows(x) for x in run()] == whole


def test_reliability(spark):
    a = spark.createDataFrame([(1, "soi", 0, "A", "B", 1.0), (1, "soi", 0, "A", "C", 1.0), (1, "soi", 0, "X", "B", 1.0), (1, "soi", 0, "X", "Gone", 1.0)], ARCS)
    none = (None, None, None)
    f = figs(spark, *[(i, t, (v, *none), False) for i in range(4) for t, v in (("A", 3.0), ("B", 1.0), ("C", 2.0), ("X", 7.0))])
    sub = spark.createDataFrame([(i, 1) for i in range(4)], "adsh long, version int")
    kept, stats = arcs.filter_unreliable_arcs(f, sub, a, min_tests=10)
    assert kept.count() == 4 and "n_tests" in stats.columns
    kept, stats = arcs.filter_unreliable_arcs(f, sub, a, min_tests=4)
    assert rows(kept, "from", "to") == [("A", "B"), ("A", "C")]
    assert rows(stats, "from", "n_terms", "n_tests", "n_fail") == [("A", 2, 4, 0), ("X", 1, 4, 4)]


def test_expand(spark):
    a = spark.createDataFrame([(1, "soi", 0, "Total", "X", 1.0), (1, "soi", 0, "Total", "Y", -1.0)], ARCS)
    got = rows(arcs.expand_arcs(a), "seq", "from", "to", "weight")
    assert [r for r in got if r[1] == "X"] == [(1, "X", "Total", 1.0), (1, "X", "Y", 1.0)]
    assert [r for r in got if r[1] == "Y"] == [(1, "Y", "Total", -1.0), (1, "Y", "X", 1.0)]


def test_colliding_signatures_are_spread(spark):
    a = spark.createDataFrame([(1, "s", 0, f, t, 1.0) for f in ("A", "B", "C") for t in ("X", "Y")], ARCS)
    got = arcs.expand_arcs(a, pivot_weights=())
    assert rows(got.select("seq", "from").distinct()) == [(0, "A"), (1, "B"), (2, "C")]
    with pytest.raises(RuntimeError):
        arcs.expand_arcs(a, pivot_weights=(), max_bump_iters=1)


def test_sequence_and_universe(spark):
    a = spark.createDataFrame([(1, "s", "A", "B", 1.0), (1, "s", "B", "C", 1.0), (1, "s", "C", "D", 1.0)], "version int, statement string, `from` string, `to` string, weight double")
    assert rows(arcs.assign_arc_sequence(a), "from", "seq") == [("A", 2), ("B", 1), ("C", 0)]
    u = spark.createDataFrame([("A",), ("B",), ("C",)], "tag string")
    assert arcs.filter_arcs_to_universe(a, u).count() == 2


def test_compute_missing(spark):
    a = spark.createDataFrame([(1, "s", 0, "A", "B", 1.0), (1, "s", 0, "A", "C", 1.0)], ARCS)
    f = figs(spark, (1, "B", (40.0, None, None, None), False), (1, "C", (60.0, None, None, None), False))
    got = arcs.compute_missing_with_arcs(f, spark.createDataFrame([(1, 1)], "adsh long, version int"), a)
    assert ("A", 100.0) in rows(got, "tag", "reported_figure")


def test_base_figures_unique_and_order_free(spark):
    k, p = ("2023-01-01", "2023-12-31"), ("2022-01-01", "2022-12-31")
    f = facts(spark, (1, "R", *k, 10.0), (1, "R", *p, 8.0), (1, "C", *k, 4.0), (1, "Cash", "2023-12-31", "2023-12-31", 5.0), (1, "R", "2023-12-31", "2023-12-31", 77.0))
    sub = spark.createDataFrame([(1, 1, D("2023-12-31"), datetime(2024, 2, 1), 0, 2023)], "adsh long, cik long, period date, accepted timestamp_ntz, amendment_adsh long, version int")
    got, enriched = figures.build_base_figures(f, sub)
    assert rows(got, "tag", *VALUES[::2], "is_instant") == [("C", 4.0, None, False), ("Cash", 5.0, None, True), ("R", 10.0, 8.0, False)]
    assert rows(figures.build_base_figures(f.orderBy(F.rand(1)), sub)[0]) == rows(got)


def test_checks(spark):
    cols = "adsh long, cik long, sic long, form string, period date, accepted timestamp_ntz, version int, amendment_adsh long, is_amended boolean, ticker string"
    good = spark.createDataFrame([(1, 1, 100, "10-K", D("2022-12-31"), datetime(2023, 2, 1), 2022, 0, False, "T")], cols)
    f = facts(spark, (1, "A", "2022-01-01", "2022-12-31", 1.0))
    limits = {"submission_limits": {"min_rows": 0}, "fact_limits": {"min_rows": 0}}
    checks.check_all(f, good, **limits)
    bad = spark.createDataFrame([(1, 1, 10001, "8-K", D("2023-12-31"), datetime(2023, 2, 1), 0, 9, False, "T")], cols)
    with pytest.raises(AssertionError) as e:
        checks.check_all(facts(spark, (5, "A", "2022-12-31", "2022-01-01", 1.0)), bad, **limits)
    assert all(x in str(e.value) for x in ("sic_too_large", "form", "no_version", "period_after_acceptance", "flag_without_link", "unknown filings", "start after"))
    gold = spark.createDataFrame([(1, "A", None), (1, "B", 2.0)], "adsh long, tag string, value1 double")
    have = spark.createDataFrame([(1, "A", None)], "adsh long, tag string, reported_figure double")
    assert rows(checks.check_golden_rows(have, gold), "tag") == [("B",)]
    assert checks.check_pivot_values(have, [(1, "tag", "A"), (1, "tag", "Z")]) == ["tag of 1 is not Z"]


def test_landed_json(spark):
    doc = '{"cik": 5, "facts": {"us-gaap": {"Cash": {"units": {"USD": [{"end": "2023-12-31", "accn": "0000000005-24-000001", "val": 7, "form": "10-K"}, {"end": "2023-12-31", "accn": "0000000005-24-000001", "val": 8, "form": "8-K"}], "EUR": [{"end": "2023-12-31", "accn": "0000000005-24-000001", "val": 9, "form": "10-K"}]}}, "Old": {"units": {"shares": [{"start": "0001-01-01", "end": "2023-12-31", "accn": "0000000005-24-000001", "val": 1, "form": "10-Q/A"}]}}}, "dei": {"EntityPublicFloat": {"units": {"USD": []}}, "Other": {"units": {"USD": [{"end": "2023-12-31", "accn": "0000000005-24-000001", "val": 3, "form": "10-K"}]}}}}}'
    docs = spark.createDataFrame([(doc,), ('{"cik": 6}',)], "content string")
    assert rows(landed.parse_company_facts(docs)) == [(524000001, "Cash", D("2023-12-31"), D("2023-12-31"), 7.0), (524000001, "Old", D("1900-01-01"), D("2023-12-31"), 1.0)]
    sub = '{"cik": "5", "sic": "", "filings": {"recent": {"accessionNumber": ["0000000005-24-000001", "0000000005-24-000002"], "form": ["10-K", "8-K"], "reportDate": ["", "2023-01-01"], "acceptanceDateTime": ["2024-02-01T10:00:00.000Z", ""], "primaryDocument": ["a.htm", "b.htm"]}}}'
    got = landed.parse_bulk_submissions(spark.createDataFrame([(sub,), ('{"cik": "6", "filings": {}}',)], "content string"))
    assert rows(got) == [(524000001, 5, 0, "10-K", None, datetime(2024, 2, 1, 10), "a.htm")]


def test_landed_files(spark, tmp_path):
    (tmp_path / "t.txt").write_text("aa\t1\nzz\t1\nbb\t2\n")
    assert rows(landed.read_ticker_map(spark, str(tmp_path / "t.txt"))) == [("aa", 1), ("bb", 2)]
    q = tmp_path / "2020q1"
    q.mkdir()
    (q / "sub.txt").write_text("adsh\tcik\tsic\tform\tperiod\taccepted\tinstance\textra\n0000000005-24-000001\t5\t\t10-K\t20231231\t2024-02-01 10:00:00.0\tx.xml\t1\n0000000005-24-000002\t5\t1\t8-K\t20231231\t2024-02-01 10:00:00.0\tx.xml\t1\n")
    (q / "num.txt").write_text("adsh\ttag\tversion\n0000000005-24-000001\tA\tus-gaap/2023\n0000000005-24-000001\tB\tus-gaap/2023\n0000000005-24-000001\tB\tdei/2022\n")
    got = landed.read_fsd_many(spark, [str(q)])
    assert rows(got, "adsh", "cik", "sic", "version", "quarter") == [(524000001, 5, 0, 2023, "2020q1")]
    (tmp_path / "e.xsd").write_text('<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:element name="Cash" type="xbrli:monetaryItemType"/><xs:element name="Abs" type="xbrli:monetaryItemType" abstract="true"/><xs:element name="Txt" type="xbrli:stringItemType"/></xs:schema>')
    assert {t for (t,) in rows(landed.read_tag_universe(spark, str(tmp_path / "e.xsd")))} == {"Cash", *landed.DEI_TAGS}
    (tmp_path / "us-gaap-soi-cal-2022.xml").write_text('<link:linkbase xmlns:link="http://www.xbrl.org/2003/linkbase" xmlns:xlink="http://www.w3.org/1999/xlink"><link:calculationArc xlink:from="loc_A" xlink:to="loc_B" weight="1.0"/><link:calculationArc xlink:from="loc_B" xlink:to="loc_C" weight="-1"/></link:linkbase>')
    assert rows(landed.read_calculation_arcs(spark, str(tmp_path / "us-gaap-soi-cal-2022.xml"))) == [(2022, "soi", 0, "B", "C", -1.0), (2022, "soi", 1, "A", "B", 1.0)]


def test_landed_instances(spark):
    doc = """<xbrl><context id="c1"><entity><identifier>5</identifier></entity><period><startDate>2023-01-01</startDate><endDate>2023-12-31</endDate></period></context>
    <xbrli:context id="c2"><xbrli:entity><xbrli:identifier>5</xbrli:identifier></xbrli:entity><xbrli:period><xbrli:instant>2023-12-31</xbrli:instant></xbrli:period></xbrli:context>
    <context id="c3"><entity><identifier>6</identifier></entity><period><instant>2023-12-31</instant></period></context>
    <unit id="u"><measure>iso4217:USD</measure></unit><unit id="e"><measure>iso4217:EUR</measure></unit>
    <us-gaap:Revenue contextRef="c1" unitRef="u">10</us-gaap:Revenue><us-gaap:Cash contextRef="c2" unitRef="u" xsi:nil="true"/><us-gaap:Cash contextRef="c3" unitRef="u">4</us-gaap:Cash>
    <us-gaap:Euro contextRef="c1" unitRef="e">4</us-gaap:Euro><us-gaap:Text contextRef="c1" unitRef="u">words</us-gaap:Text></xbrl>"""
    docs = spark.createDataFrame([(1, 5, doc)], "adsh long, cik long, content string")
    want = [(1, "Cash", D("2023-12-31"), D("2023-12-31"), 0.0), (1, "Revenue", D("2023-01-01"), D("2023-12-31"), 10.0)]
    assert rows(landed.read_xbrl_instances(docs)) == want
    sub = spark.createDataFrame([(1, 5), (2, 5)], "adsh long, cik long")
    have = facts(spark, (2, "A", "2023-01-01", "2023-12-31", 1.0))
    assert landed.backfill_missing_facts(have, sub, docs.select("adsh", "content")).count() == 3
    summary = '<R><InputFiles><File doctype="EX">a.htm</File><File doctype="10-K">x.htm.htm</File></InputFiles><BaseTaxonomies><BaseTaxonomy>http://fasb.org/us-gaap/2023</BaseTaxonomy></BaseTaxonomies></R>'
    got = landed.read_filing_summary(spark.createDataFrame([(1, summary)], "adsh long, content string")).first()
    assert got["file"] == "x.htm.htm" and got["namespaces"] == ["http://fasb.org/us-gaap/2023"]
    names = spark.createDataFrame([("x.htm.htm",), ("y.xml",)], "f string")
    assert rows(names.select(scalars.instance_file_name(F.col("f")))) == [("x.htm_htm.xml",), ("y.xml",)]
    missing = landed.lookup_missing_submissions(spark.createDataFrame([(524000001,)], "adsh long"), spark.createDataFrame([(524000001, 5), (524000002, 5), (7, 0)], "adsh long, cik long"))
    assert rows(missing) == [(524000001, 5)]


def test_landed_instances_in_other_writing(spark):
    """Single quotes, spaces around =, comments and CDATA sections."""
    doc = """<xbrl><!-- <context id="c1"><entity><identifier>6</identifier></entity></context> --><context id='c1'><entity><identifier>5</identifier></entity><period><instant>2023-12-31</instant></period></context>
    <unit id='u'><measure>iso4217:USD</measure></unit><us-gaap:Cash contextRef = 'c1' unitRef='u'><![CDATA[12]]></us-gaap:Cash><!-- <us-gaap:Old contextRef="c1" unitRef="u">4</us-gaap:Old> --></xbrl>"""
    got = landed.read_xbrl_instances(spark.createDataFrame([(1, 5, doc)], "adsh long, cik long, content string"))
    assert rows(got) == [(1, "Cash", D("2023-12-31"), D("2023-12-31"), 12.0)]
    summary = "<R><InputFiles><!-- <File doctype='10-K'>no.htm</File> --><File doctype = '10-Q'>x.htm</File></InputFiles></R>"
    assert landed.read_filing_summary(spark.createDataFrame([(1, summary)], "adsh long, content string")).first()["file"] == "x.htm"


def test_links_against_pairs(spark):
    """Every pair of filings looked at: random ends, forms, amendments, nulls, and filings of several rows."""
    import random

    rnd = random.Random(5)
    day = lambda: D("2020-01-31") + timedelta(days=rnd.choice([0, 1, 5, 90, 91, 181, 272, 365, 366, 370, 375, 376, 380, 731]))
    data = [(k, rnd.choice([1, 1, 1, 2, None]), rnd.choice(["10-K", "10-K/A", "10-Q", "10-Q/A"]), rnd.choice([D("2020-01-01"), D("2020-04-01"), None]), rnd.choice([day(), day(), day(), None]), rnd.choice([True, False, False, None])) for k in range(1, 120)]
    data += data[:5]
    sub = spark.createDataFrame(data, "adsh long, cik long, form string, start_rep date, end_rep date, is_amended boolean")
    fam = lambda f: f[:4]
    year = lambda d: d.replace(year=d.year - 1, day=28 if (d.month, d.day) == (2, 29) else d.day)
    ten_k, py, prev = {}, {}, {}
    for a, cik, form, start, end, _ in data:
        other = [x for x in data if cik is not None and x[1] == cik and x[4] is not None and end is not None and not x[5]]
        ten_k[a] = max(((x[4], x[0]) for x in other if x[2].startswith("10-K") and 1 <= (end - x[4]).days <= 375), default=None)
        py[a] = max(((-abs((x[4] - year(end)).days), x[4], x[0]) for x in other if fam(x[2]) == fam(form) and abs((x[4] - year(end)).days) <= 10), default=None)
        prev[a] = max(((x[4], x[0], x[2]) for x in other if x[3] is not None and x[3] == start and x[4] < end), default=None)
    ends = {x[0]: x[4] for x in data}
    got = {r["adsh"]: r for r in links.all_links(sub).collect()}
    assert len(got) == 119 and links.all_links(sub).count() == 119
    for a, r in got.items():
        assert (r["prev_10k_adsh"], r["prev_10k_diff_days"]) == ((ten_k[a][1], (ends[a] - ten_k[a][0]).days) if ten_k[a] else (0, 0))
        assert (r["adsh_py"], r["py_diff_days"]) == ((py[a][2], -py[a][0]) if py[a] else (0, 0))
        assert (r["prev_adsh"], r["prev_form"]) == (prev[a][1:] if prev[a] else (0, None))


def test_windows_by_either_way(spark):
    """The one-pass windows are what the single operators give."""
    import random

    rnd = random.Random(6)
    first = D("2022-12-31")
    data = []
    for k in range(150):
        end = first + timedelta(days=rnd.randrange(0, 40))
        for _ in range(rnd.randrange(0, 25)):
            e = rnd.choice([end, end, end + timedelta(days=rnd.randrange(-5, 40)), end.replace(year=end.year - 1), None])
            s = rnd.choice([None, e, e - timedelta(days=rnd.choice([89, 90, 91, 364, 365, 372, 380]))]) if e else None
            data.append((k, rnd.choice("ABC"), s, e, 1.0))
    f = spark.createDataFrame(data, "adsh long, tag string, start date, end date, value double")
    sub = spark.createDataFrame([(k, first + timedelta(days=rnd.randrange(0, 40))) for k in range(150)], "adsh long, period date")
    ranges = windows.rank_ranges(f, windows.best_end_per_filing(f, sub))
    want = ranges.unionByName(windows.align_prior_year_ranges(f, windows.best_end_per_filing(f, sub, years_back=1), ranges))
    got = windows.infer_reporting_windows(f, sub)
    assert got.dtypes == want.dtypes and rows(got) == rows(want) and got.where("enum = 4").count() > 3


# ---- shuffles


def test_lookups_join_once_and_keep_rows_without_a_tag(spark):
    figs = spark.createDataFrame([(1, "A", 1.0), (2, "A", 2.0), (2, "B", 3.0), (2, None, 4.0), (2, None, 5.0), (None, "A", 6.0)], "adsh long, tag string, v double")
    link = spark.createDataFrame([(1, 0), (2, 1)], "adsh long, prev_adsh long")
    got = links.lookup_by_link(figs, link, "prev_adsh", {"v": "before"})
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted([(1, "A", 1.0, 0, None), (2, "A", 2.0, 1, 1.0), (2, "B", 3.0, 1, None), (2, None, 4.0, 1, None), (2, None, 5.0, 1, None), (None, "A", 6.0, None, None)], key=str)


def test_lookups_find_figures_at_other_places(spark):
    """Links of any filing to any other, whatever company each is dealt to, against a dictionary; one filing has no links row of its own."""
    import random

    rnd = random.Random(8)
    data = [(a, t, float(100 * a + ord(t))) for a in range(1, 40) for t in "ABC" if rnd.random() < 0.7]
    found = [(a, rnd.choice([0, None, *range(1, 40)]), rnd.choice([0, 7, *range(1, 40)]), rnd.choice([None, 1, 2, 3])) for a in range(1, 39)]
    figs_, sub = spark.createDataFrame(data, "adsh long, tag string, v double"), spark.createDataFrame(found, "adsh long, p long, q long, cik long")
    had, to = {(a, t): v for a, t, v in data}, {a: (p, q) for a, p, q, _ in found}
    want = sorted((a, t, v, *[had.get((x, t)) for x in to.get(a, (0, 0))]) for a, t, v in data)
    for link in (sub, sub.drop("cik")):
        got = links.lookup_by_links(figs_, link, {"p": {"v": "vp"}, "q": {"v": "vq"}}, keep=[])
        assert sorted(map(tuple, got.collect())) == want


def test_gathered_figures_are_shuffled_no_more(spark):
    """The four functions one after another, and derive_figures, add no shuffle to the two of gathered figures, and derive the same."""
    figures, sub = spark.createDataFrame([(a, t, 10.0 * a + ord(t), None, None, None, False, False) for a in range(1, 9) for t in "AB"], FIG), many_quarters(spark)
    found = links.all_links(sub).localCheckpoint()
    gathered = derive.gather_figures(figures, found)
    step = derive.fill_prior_year(derive.fill_quarterly(gathered, sub, check=False, links=found), sub, links=found)
    step = derive.annual_prior_year(derive.annual_current(step, sub, links=found), sub, links=found)
    both = derive.derive_figures(figures, sub, check=False, links=found)
    exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert exchanges(step) == exchanges(both) == exchanges(gathered) > 0
    plain = derive.fill_prior_year(derive.fill_quarterly(figures, sub), sub)
    plain = derive.annual_prior_year(derive.annual_current(plain, sub), sub)
    assert rows(step, *plain.columns) == rows(plain) == rows(both, *plain.columns) and plain.where("annual_figure_py is not null").count() == 2


def many_quarters(spark, *more):
    ends = ["2021-03-31", "2021-06-30", "2021-09-30", "2021-12-31", "2022-03-31", "2022-06-30", "2022-09-30", "2022-12-31"]
    return links_sub(spark, *[(k, 1, "10-K" if e.endswith("12-31") else "10-Q", f"{e[:4]}-01-01", e, False) for k, e in enumerate(ends, 1)], *more)


def test_filings_of_several_companies_are_derived_alike(spark):
    """Filing 5 is company 2's, too, and its last year's filing is that one's: figures are not dealt by company then."""
    figures = spark.createDataFrame([(a, "A", 10.0 * a, None, None, None, False, False) for a in (*range(1, 9), 20, 21)], FIG)
    sub = many_quarters(spark, (5, 2, "10-Q", "2022-01-01", "2022-03-31", False), (20, 2, "10-Q", "2021-01-01", "2021-03-31", False), (21, 3, "10-K", "2021-01-01", "2021-12-31", False))
    found = links.all_links(sub).localCheckpoint()
    assert {r["adsh"]: r["shared"] for r in found.collect()}[5] and derive.gather_figures(figures, found).columns == figures.columns
    plain = derive.fill_prior_year(derive.fill_quarterly(figures, sub), sub)
    plain = derive.annual_prior_year(derive.annual_current(plain, sub), sub)
    both = derive.derive_figures(figures, sub)
    assert rows(both, *plain.columns) == rows(plain) and {r["adsh"]: r["reported_figure_py"] for r in both.collect()}[5] == 200.0


def test_cells_are_looked_for_without_a_row_for_each(spark):
    wide = spark.createDataFrame([(1, 1.0, None, "x"), (2, float("nan"), 0.0, "x"), (2, 5.0, None, "x"), (None, 1.0, 1.0, "x")], "adsh long, A_q double, A_a double, form string")
    held = [(1, "A_q", 1.0), (1, "A_a", None), (2, "A_q", float("nan")), (2, "A_q", 5.0), (2, "A_a", -0.0), (2, "A_a", None)]
    lost = [(1, "A_q", None), (1, "A_q", 2.0), (1, "B_q", None), (1, "form", None), (1, None, 1.0), (2, "A_a", 5.0), (3, "A_q", None), (None, "A_q", 1.0)]
    cells = spark.createDataFrame(held + lost + lost[:2], "adsh long, column string, value double")
    got = checks.missing_pivot_cells(wide, cells)
    assert rows(got) == sorted(lost, key=str) and rows(checks.missing_pivot_cells(wide.select("adsh", "form"), cells.limit(1))) == held[:1]
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()


def test_intervals_never_meet_at_the_filings_without_links(spark):
    day = "date'2020-03-31'"
    sub = spark.sql(f"select id adsh, id cik, '10-Q' form, {day} start_rep, {day} end_rep, {day} start_rep_py, {day} end_rep_py, {day} start_q, {day} end_q, {day} start_q_py, {day} end_q_py, false is_amended from range(1, 5)")
    found = spark.sql("select id adsh, 0L prev_10k_adsh, 0L adsh_py, 0L prev_adsh from range(1, 5)")
    plan = derive.impute_intervals(sub, links=found)._jdf.queryExecution().analyzed().toString()
    assert "Join UsingJoin" not in plan and plan.count("__to#") > 0 and derive.impute_intervals(sub, links=found).count() == 4


def test_contradictions_need_no_shuffle_after_merging(spark):
    facts = spark.sql("select id adsh, 'A' tag, date'2020-01-01' start, date'2020-03-31' end, 1.0D value from range(4)")
    sub = spark.sql("select id adsh, 0L amendment_adsh, timestamp_ntz'2020-05-01 00:00:00' accepted from range(4)")
    rows = clean.drop_contradictions(amendments.merge_amendments(facts, sub))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "ENSURE_REQUIREMENTS" not in plan.split("REPARTITION_BY_COL")[0] and rows.count() == 4
