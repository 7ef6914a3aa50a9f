"""Readers of files and documents, assertions, and what plans must not do."""

from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerloom import catalog
from ledgerloom.operators import amendments, arcs, checks, clean, derive, figures, links
from ledgerloom.plans import adapter
from ledgerloom.schemas import FACTS
from ledgerloom.sources import landed, markup

D = date.fromisoformat
SF = "/root/testdata/sf0.001"
FIG = "adsh long, tag string, reported_figure double, quarterly_figure double, reported_figure_py double, quarterly_figure_py double, is_computed boolean, is_instant boolean"
EDGES = "version int, statement string, `from` string, `to` string, weight double"
needs_data = pytest.mark.skipif(not Path(SF).exists(), reason="the driver's tables are not here")


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def shuffles(df):
    """Shuffles of the plan that runs, reused ones not counted."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    return sum("Exchange " in line and "BroadcastExchange" not in line and "ReusedExchange" not in line for line in final.splitlines())


def instance(body, root='xmlns="http://www.xbrl.org/2003/instance" xmlns:g="http://fasb.org/us-gaap/2023"'):
    return f"""<?xml version="1.0"?><xbrl {root}><context id="c"><entity><identifier scheme="s">0005</identifier></entity><period><instant>2023-12-31</instant></period></context>
        <unit id="u"><measure>iso4217:USD</measure></unit><unit id="s"><measure>shares</measure></unit><unit id="q"><divide><unitNumerator><measure>iso4217:USD</measure></unitNumerator><unitDenominator><measure>shares</measure></unitDenominator></divide></unit>{body}</xbrl>"""


def read(spark, *docs, **how):
    df = spark.createDataFrame([(i, 5, d) for i, d in enumerate(docs, 1)], "adsh long, cik long, content string")
    return [(r["adsh"], r["tag"], r["value"]) for r in sorted(landed.read_xbrl_instances(df, **how).collect(), key=str)]


def test_units_of_quotients_are_no_money(spark):
    doc = instance('<g:Eps contextRef="c" unitRef="q">1.25</g:Eps><g:Cash contextRef="c" unitRef="u">7</g:Cash><g:Shares contextRef="c" unitRef="s">3</g:Shares><g:None contextRef="c">4</g:None>')
    assert read(spark, doc) == [(1, "Cash", 7.0), (1, "Shares", 3.0)]


def test_namespaces_decide_and_not_prefixes(spark):
    body = '<{0}:Cash contextRef="c" unitRef="u">7</{0}:Cash>'
    own = 'xmlns="http://www.xbrl.org/2003/instance" xmlns:us-gaap="http://company.example/x" xmlns:z="http://xbrl.sec.gov/dei/2022"'
    # a usual prefix bound to something else, another bound to dei, and instance elements under a prefix that stands for something else
    other = 'xmlns:i="http://elsewhere.example" xmlns:g="http://fasb.org/us-gaap/2023"'
    foreign = instance(body.format("g"), other).replace("<context", "<i:context").replace("</context", "</i:context")
    assert read(spark, instance(body.format("us-gaap"), own), instance(body.format("z"), own), foreign, instance(body.format("us-gaap"), "")) == [(2, "Cash", 7.0), (4, "Cash", 7.0)]
    docs = (instance(body.format("g")), instance(body.format("g")), instance(body.format("g")))
    summaries = spark.createDataFrame([(1, ["http://fasb.org/us-gaap/2023"]), (2, ["http://fasb.org/us-gaap/2022"])], "adsh long, namespaces array<string>")
    assert read(spark, *docs, summaries=summaries) == [(1, "Cash", 7.0)]


def test_odd_instances(spark):
    """Entities, CDATA, comments, > in attributes, nil, text that is no number, contexts twice or of nobody, and what is no XML."""
    body = """<g:A contextRef="c" unitRef="u" note="a > b">1&#50;</g:A><g:B contextRef='c' unitRef='u'><![CDATA[ 3 ]]></g:B><!-- <g:C contextRef="c" unitRef="u">4</g:C> --><g:D contextRef="c" unitRef="u" xsi:nil="true"/>
        <g:E contextRef="c" unitRef="u">true</g:E><g:F contextRef="no" unitRef="u">5</g:F><g:G contextRef="c" unitRef="u">1e3</g:G><g:H contextRef="c2" unitRef="u">6</g:H>
        <context id="c"><entity><identifier>5</identifier></entity><period><instant>2024-12-31</instant></period></context><context id="c2"><entity><identifier>x</identifier></entity></context>"""
    assert read(spark, instance(body), None, "", "no xml", "<broken", "<xbrl/>") == [(1, "A", 12.0), (1, "B", 3.0), (1, "D", 0.0), (1, "G", 1000.0)]
    empty = spark.createDataFrame([], "adsh long, cik long, content string")
    assert landed.read_xbrl_instances(empty).count() == 0 and landed.read_filing_summary(empty.select("adsh", "content")).count() == 0
    got = landed.read_filing_summary(spark.createDataFrame([(1, None), (2, "<a>"), (3, "<R><InputFiles/></R>")], "adsh long, content string"))
    assert rows(got) == [(1, None, []), (2, None, []), (3, None, [])]


def test_instances_are_read_in_one_scan(spark):
    plan = landed.read_xbrl_instances(spark.createDataFrame([(1, 5, instance(""))], "adsh long, cik long, content string"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("from_xml") == 1


def test_elements_of_nested_documents(spark):
    df = spark.createDataFrame([('<r xmlns:a="u" xmlns="v"><a:x k="1">t</a:x><y><z k="2"/></y></r>',)], "c string")
    got = df.select(markup.elements(F.col("c"), 2, ("k",)).alias("e"), markup.declared_namespaces(F.col("c")).alias("n")).first()
    assert [(e["_n"], e["_p"], e["_k"], e["_VALUE"]) for e in got["e"]][0] == ("x", "a", "1", "t")
    assert got["e"][1]["e"][0]["_n"] == "z" and got["e"][1]["e"][0]["_k"] == "2" and {tuple(n) for n in got["n"]} == {("a", "u"), ("", "v")}


def test_only_the_files_of_the_companies_are_opened(spark, tmp_path):
    for cik in (1, 2, 3):
        (tmp_path / f"CIK{cik:010d}.json").write_text(f'{{"cik": {cik}, "facts": {{"us-gaap": {{"Cash": {{"units": {{"USD": [{{"end": "2023-12-31", "accn": "0000000005-24-00000{cik}", "val": {cik}, "form": "10-K"}}]}}}}}}}}}}')
    ciks = spark.createDataFrame([(1,), (3,), (None,), (3,), (77,)], "cik long")
    some = landed.read_company_facts(spark, str(tmp_path), ciks=ciks)
    assert "DataFilters: [file_name" in some._jdf.queryExecution().executedPlan().toString()
    (tmp_path / "CIK0000000002.json").unlink()  # would fail if it were opened
    assert rows(some, "value") == [(1.0,), (3.0,)]
    landed.NAMED_FILES, most = 1, landed.NAMED_FILES
    try:
        assert rows(landed.read_company_facts(spark, str(tmp_path), ciks=ciks), "value") == [(1.0,), (3.0,)]
    finally:
        landed.NAMED_FILES = most


def test_linkbases_of_years_and_statements(spark, tmp_path):
    text = '<link:linkbase xmlns:link="http://www.xbrl.org/2003/linkbase" xmlns:xlink="http://www.w3.org/1999/xlink"><link:calculationLink><link:calculationArc xlink:from="loc_A" xlink:to="loc_{}" weight="1"/></link:calculationLink></link:linkbase>'
    for name in ("soi-cal-2022", "soi-cal-2012-01-31", "soc-cal-2022", "soi-pre-2022", "soi-cal-2010", "other-cal-2022"):
        (tmp_path / name[-4:]).mkdir(exist_ok=True)
        (tmp_path / name[-4:] / f"us-gaap-stm-{name}.xml").write_text(text.format(name[:3].upper()))
    assert rows(landed.read_calculation_arcs_many(spark, str(tmp_path)), "version", "statement", "to") == [(2012, "soi", "SOI"), (2022, "soc", "SOC"), (2022, "soi", "SOI")]
    assert rows(landed.read_calculation_arcs_many(spark, str(tmp_path), years=[2022], statements=["soi"]), "version", "statement", "seq", "from", "to", "weight") == [(2022, "soi", 0, "A", "SOI", 1.0)]


def test_quarters_keep_their_own_columns_and_years(spark, tmp_path):
    a, b = tmp_path / "2020q1", tmp_path / "2020q2"
    for q, head, line, num in ((a, "adsh\tcik\tsic\tform\tperiod\taccepted\tinstance", "0000000005-24-000001\t5\t1\t10-K\t20231231\t2024-02-01 10:00:00\tx.xml", "us-gaap/2019"), (b, "form\tinstance\tadsh\tcik\tsic\taccepted\tperiod\tname", "10-K\tx.xml\t0000000005-24-000001\t5\t\t2024-02-01 10:00:00\t20231231.0\tn", "us-gaap/2020")):
        q.mkdir()
        (q / "sub.txt").write_text(f"{head}\n{line}\n")
        (q / "num.txt").write_text(f"adsh\ttag\tversion\n0000000005-24-000001\tA\t{num}\n")
    want = [(524000001, 0, "10-K", D("2023-12-31"), 2020, "2020q2")]
    assert rows(landed.read_fsd_many(spark, [str(a), str(b)]), "adsh", "sic", "form", "period", "version", "quarter") == want
    assert rows(landed.read_fsd_many(spark, [str(a), str(b)], keep_all=True), "sic", "version", "quarter") == [(0, 2020, "2020q2"), (1, 2019, "2020q1")]
    assert rows(landed.read_fsd_submissions(spark, str(a / "sub.txt"), str(a / "num.txt")), "adsh", "version") == [(524000001, 2019)]


def test_arcs_in_a_circle_raise(spark):
    edge = lambda *pairs: spark.createDataFrame([(1, "s", a, b, 1.0) for a, b in pairs] + [(2, "s", "A", "B", 1.0)], EDGES)
    with pytest.raises(ValueError, match=r"circle.*'A'.*'B'.*'C'"):
        arcs.assign_arc_sequence(edge(("A", "B"), ("B", "C"), ("C", "A"), ("X", "A"), ("C", "Y")))
    with pytest.raises(ValueError, match="circle"):
        arcs.assign_arc_sequence(edge(("A", "A")))
    # 130 levels, a diamond at each: no bound, and paths are not counted one by one
    deep = [(f"n{i}", f"{side}{i + 1}") for i in range(64) for side in "ab"] + [(f"{side}{i + 1}", f"n{i + 1}") for i in range(64) for side in "ab"]
    got = {r["from"]: r["seq"] for r in arcs.assign_arc_sequence(edge(*deep)).where("version = 1").collect()}
    assert got["n0"] == 127 and got["a64"] == 0 and got["n63"] == 1
    assert arcs.assign_arc_sequence(edge().limit(0)).count() == 0


def test_amendments_in_a_circle(spark, caplog):
    sub = lambda *pairs: spark.createDataFrame(list(pairs), "adsh long, amendment_adsh long")
    assert rows(amendments.canonical_adsh_map(sub((1, 2), (2, 3), (3, 1), (9, 1), (10, 9), (4, 0), (20, 21)))) == [(1, 1), (10, 1), (2, 1), (20, 21), (3, 1), (4, 4), (9, 1)]
    assert "circle" in caplog.text
    assert rows(amendments.circular_amendments(sub((5, 6), (6, 7), (7, 8), (8, 5), (1, 5), (20, 21), (3, 0)))) == [(5,), (6,), (7,), (8,)]
    caplog.clear()
    assert {r[1] for r in rows(amendments.canonical_adsh_map(sub(*[(i, i + 1) for i in range(1, 100)])))} == {100} and not caplog.text


def test_repeated_figures_fail(spark):
    sub = spark.createDataFrame([(1, 1, "10-Q", D("2023-01-01"), D("2023-03-31"), False), (2, 1, "10-Q", D("2023-01-01"), D("2023-06-30"), False)], "adsh long, cik long, form string, start_rep date, end_rep date, is_amended boolean")
    one = [(1, "R", 30.0, None, None, None, False, False), (2, "R", 70.0, None, None, None, False, False)]
    assert rows(derive.fill_quarterly(spark.createDataFrame(one, FIG), sub), "adsh", "quarterly_figure") == [(1, 30.0), (2, 40.0)]
    twice = spark.createDataFrame([*one, (1, "R", 31.0, None, None, None, False, False)], FIG)
    for run in (derive.fill_quarterly, derive.fill_prior_year, derive.annual_current, derive.derive_figures):
        with pytest.raises(Exception, match="several figures of filing 1 and tag R"):
            run(twice, sub).collect()
    with pytest.raises(Exception, match="several figures of filing 1 and tag R"):
        derive.annual_prior_year(twice.withColumn("annual_figure", F.lit(1.0)), sub).collect()
    assert links.lookup_by_link(twice.where("adsh = 2"), links.prev_filing_link(sub), "prev_adsh", {"reported_figure": "x"}).first()["x"] is None


@needs_data
def test_two_rounds_give_what_four_functions_give(spark):
    rows_, sub = adapter.link_figures(spark, SF), adapter.sub_windows(spark, SF)
    step = derive.fill_prior_year(derive.fill_quarterly(rows_, sub), sub)
    step = derive.annual_prior_year(derive.annual_current(step, sub), sub)
    both = derive.derive_figures(rows_, sub)
    assert set(both.columns) == set(step.columns) and rows(both, *step.columns) == rows(step)


@needs_data
def test_shuffles_of_the_transform(spark):
    """Twelve shuffles at most behind the cuts; equations of six levels shuffle figures once."""
    assert shuffles(catalog.queries()["transform_and_pivot"](spark, SF)) <= 12
    six = [(1, "soi", k, f"T{k}", t, 1.0) for k in range(6) for t in (("X", "Y") if not k else (f"T{k - 1}", "Z"))]
    got = arcs.apply_arcs_by_version(adapter.arc_figures(spark, SF), adapter.arc_submissions(spark, SF), spark.createDataFrame(six, "version int, statement string, seq int, `from` string, `to` string, weight double"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 1 and plan.count("Exchange hashpartitioning(adsh") - plan.count("REPARTITION_BY_COL") <= 2  # the others join the version
    cents = {r["adsh"]: r["reported_figure"] for r in got.where("tag = 'X'").collect()}
    assert all(r["reported_figure"] == cents[r["adsh"]] * (3 + 4 * 5) and r["is_computed"] for r in got.where("tag = 'T5'").collect())


def test_equations_of_several_totals_and_originals(spark):
    """One component in two equations, an equation over an original, a null original, an instant, a null component; both policies."""
    fig = lambda *data: spark.createDataFrame([(1, t, v, None, None, None, False, i) for t, v, i in data], FIG)
    arc = spark.createDataFrame([(0, "A", "X", 1.0), (0, "B", "X", 2.0), (0, "A", "Y", 1.0), (0, "N", "X", 1.0), (1, "C", "A", 1.0), (0, "Z", "W", 1.0)], "seq int, `from` string, `to` string, weight double")
    f = fig(("X", 1.0, True), ("Y", 2.0, False), ("B", 9.0, True), ("N", None, False), ("W", None, True))
    read = lambda **how: {r["tag"]: (r["reported_figure"], r["is_computed"], r["is_instant"]) for r in arcs.apply_arcs(f, arc, **how).collect()}
    assert read() == {"X": (1.0, False, True), "Y": (2.0, False, False), "B": (9.0, False, True), "N": (None, False, False), "W": (None, False, True), "A": (3.0, True, False), "C": (3.0, True, False), "Z": (0.0, True, True)}
    assert {t: v for t, v in read(keep_original_first=False).items() if t in "BN"} == {"B": (2.0, True, True), "N": (1.0, True, True)}
    no = spark.createDataFrame([], "seq int, `from` string, `to` string, weight double")
    assert rows(arcs.apply_arcs(f, no), "tag", "reported_figure") == rows(f, "tag", "reported_figure")


def test_corrections_are_reported(spark):
    ends = ["2022-03-31", "2022-06-30", "2022-09-30", "2022-12-31"]
    f = spark.createDataFrame([(i, "Cash", D(e), D(e), 1000.0 * (1000 if i == 2 else 1)) for i, e in enumerate(ends)], FACTS)
    sub = spark.createDataFrame([(i, 1, D(e), datetime(2023, 1, 1), 0, 2022) for i, e in enumerate(ends)], "adsh long, cik long, period date, accepted timestamp_ntz, amendment_adsh long, version int")
    _, n = clean.correct_scale_outliers(f, sub)
    assert (n, n.rounds, n.settled) == (1, 1, True)
    got = figures.report_base_figures(f, sub)
    assert (got.corrections, got.corrections.rounds) == (1, 1) and got.figures.count() == figures.build_base_figures(f, sub)[0].count()
    policy = type("P", (), {**{k: getattr(clean.POLICY, k) for k in ("outlier_neighbour_days", "min_period_days")}, "max_outlier_rounds": 0})
    clean.POLICY, kept = policy, clean.POLICY
    try:
        fixed, n = clean.correct_scale_outliers(f, sub)
    finally:
        clean.POLICY = kept
    assert (n, n.rounds, n.settled) == (0, 0, False) and rows(fixed) == rows(f)


def test_missing_cells(spark):
    wide = spark.createDataFrame([(1, 2.0, None), (2, 3.0, 4.0)], "adsh long, a double, b double")
    cells = spark.createDataFrame([(1, "a", 2.0), (1, "b", None), (2, "a", 9.0), (3, "a", 1.0), (2, "c", 1.0)], "adsh long, `column` string, value double")
    assert rows(checks.missing_pivot_cells(wide, cells)) == [(2, "a", 9.0), (2, "c", 1.0), (3, "a", 1.0)]


@pytest.mark.parametrize("named", [False, True])
def test_namespaces_are_looked_for_once_a_document(spark, named):
    """Neither in pushed filters nor, for every element, in lambdas; units and contexts aren't either."""
    docs = spark.createDataFrame([(1, 7, "<xbrl/>")], "adsh long, cik long, content string")
    summaries = spark.createDataFrame([(1, ["http://fasb.org/us-gaap/2023"])], "adsh long, namespaces array<string>") if named else None
    plan = landed.read_xbrl_instances(docs, summaries=summaries)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml") == 1 and plan.count("regexp_extract_all") == 1 and plan.count("array_sort") == 1 and plan.count("= measure)") <= 2
