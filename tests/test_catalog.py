"""Every registered query with SQL gives DuckDB's rows on the smallest tables; signatures are spread like a plain loop does it."""

import math
import subprocess
import sys
from pathlib import Path

import pytest

from ledgerloom import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem".split()
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="the driver's tables are not here")


def normal(df):
    df = df.reindex(sorted(df.columns), axis=1)

    def cell(v):
        if v is None or v != v:
            return None
        return float(v) if isinstance(v, int | float) or hasattr(v, "dtype") else v

    return list(df.columns), sorted((tuple(map(cell, r)) for r in df.itertuples(index=False)), key=lambda r: [(x is None, str(x)) for x in r])


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_against_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    mine, theirs = normal(catalog.queries()[name](spark, SF).toPandas()), normal(con.sql(catalog.oracle_sql()[name]).df())
    assert mine[0] == theirs[0]
    assert mine[1] == theirs[1]


def test_expanded_signatures(spark):
    """expand_arcs_unique against a loop over sets."""
    base = [tuple(r) for r in catalog.queries()["expand_arcs"](spark, SF).collect()]
    equations = {}
    for v, s, seq, a, b, w in base:
        equations.setdefault((v, s, seq, a), {})[b] = w
    while True:
        groups = {}
        for k, parts in equations.items():
            groups.setdefault((*k[:3], tuple(sorted(parts))), []).append(k)
        moves = {k: rank for g in groups.values() for rank, k in enumerate(sorted(g)) if rank}
        if not moves:
            break
        merged = {}
        for k, parts in equations.items():
            merged.setdefault((k[0], k[1], k[2] + moves.get(k, 0), k[3]), {}).update(parts)
        equations = merged
    order = {v: sorted({k[2] for k in equations if k[0] == v}) for v in {k[0] for k in equations}}
    want = sorted((v, s, order[v].index(seq), a, b, w) for (v, s, seq, a), parts in equations.items() for b, w in parts.items())
    assert sorted(tuple(r) for r in catalog.queries()["expand_arcs_unique"](spark, SF).collect()) == want


def test_whole_table_is_expanded(spark):
    """Every equation of part is in expand_arcs_whole, and expand_arcs_unique_whole spreads all of them like a plain loop."""
    part = spark.read.parquet(f"{SF}/part.parquet").selectExpr("cast(p_size % 3 as int)", "p_brand", "p_type").distinct().collect()
    base = [tuple(r) for r in catalog.queries()["expand_arcs_whole"](spark, SF).collect()]
    assert {(v, a, b) for v, _, seq, a, b, _ in base if seq == 0} == {tuple(r) for r in part}
    equations = {}
    for v, s, seq, a, b, w in base:
        equations.setdefault((v, s, seq, a), {})[b] = w
    while True:
        groups = {}
        for k, parts in equations.items():
            groups.setdefault((*k[:3], tuple(sorted(parts))), []).append(k)
        moves = {k: rank for g in groups.values() for rank, k in enumerate(sorted(g)) if rank}
        if not moves:
            break
        merged = {}
        for k, parts in equations.items():
            merged.setdefault((k[0], k[1], k[2] + moves.get(k, 0), k[3]), {}).update(parts)
        equations = merged
    order = {v: sorted({k[2] for k in equations if k[0] == v}) for v in {k[0] for k in equations}}
    want = sorted((v, s, order[v].index(seq), a, b, w) for (v, s, seq, a), parts in equations.items() for b, w in parts.items())
    assert sorted(tuple(r) for r in catalog.queries()["expand_arcs_unique_whole"](spark, SF).collect()) == want


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert not math.isnan(len(__spark_entry__.queries()))


@pytest.mark.parametrize("block", ["", "sys.modules['corpus_pipeline'] = None; "])
def test_import_needs_no_session_nor_the_other_half(block):
    code = f"import sys; {block}import __spark_entry__ as e; print(len(e.queries()), any(k.startswith('op') for k in e.queries()))"
    said = subprocess.run([sys.executable, "-B", "-c", code], cwd=Path(__file__).parent.parent, capture_output=True, text=True, check=True).stdout.split()
    assert int(said[0]) >= len(catalog.queries()) and (said[1] == "False" or not block)


def test_no_python_in_plans(spark):
    for name in ("period_values", "transform_and_pivot", "company_facts"):
        plan = catalog.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan
