"""Calculation equations: from = sum of weight * to.

Arcs are a small table (a few thousand rows per taxonomy year); its size is checked before it is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import VALUES, require_columns
from .checkpoints import cut, unlimited_recursion

EQUATION = ("version", "statement", "seq", "from")
MAX_BUMPS = 50
#: Levels of equations in one plan.
CUT_LEVELS = 16
#: Arcs up to this number of rows are broadcast; some 50 MB.
BROADCAST_ARCS = 500_000
#: Figures that one task holds while equations are applied, by a count of them; some 600 MB with the sorts of two levels.
FIGURES_A_TASK = 500_000


def _small(arcs: DataFrame) -> DataFrame:
    return F.broadcast(arcs) if arcs.limit(BROADCAST_ARCS + 1).count() <= BROADCAST_ARCS else arcs


def filter_arcs_to_universe(arcs: DataFrame, universe: DataFrame) -> DataFrame:
    """Arcs whose ends are both in universe (tag)."""
    tags = universe.select("tag").distinct()
    return arcs.join(tags.withColumnRenamed("tag", "from"), "from", "left_semi").join(tags.withColumnRenamed("tag", "to"), "to", "left_semi").select(*arcs.columns)


def assign_arc_sequence(arcs: DataFrame, *, by: tuple[str, ...] = ("version", "statement")) -> DataFrame:
    """seq: height of `from` in the dependency order, totals of leaves 0, by a recursive query.

    Every step of the recursion goes from totals to the totals that they are part of; a path has no more steps than its group has
    totals, unless it goes in a circle. ValueError naming the totals of circles.
    """
    keys = [c for c in by if c in arcs.columns]
    rows = cut(arcs.drop("seq"))
    edges = cut(rows.select(*keys, "from", "to").dropna().distinct())
    most = edges.groupBy(*keys).agg(F.countDistinct("from").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    named = lambda prefix: "".join(f"{prefix}`{k}`, " for k in keys)
    query = f"""
        WITH RECURSIVE climb({named('')}total, height) MAX RECURSION LEVEL {most + 1} AS (
          SELECT DISTINCT {named('')}`from`, 0 FROM {{edges}}
          UNION ALL
          SELECT DISTINCT {named('e.')}e.`from`, c.height + 1 FROM climb c JOIN {{edges}} e ON c.total = e.`to`{"".join(f" AND c.`{k}` = e.`{k}`" for k in keys)})
        SELECT {named('')}total AS `from`, max(height) AS seq FROM climb GROUP BY {named('')}total"""
    try:
        with unlimited_recursion(edges.sparkSession):
            heights = cut(edges.sparkSession.sql(query, edges=edges))
    except Exception as e:
        if "RECURSION_LEVEL_LIMIT_EXCEEDED" in str(e):
            raise ValueError(f"arcs go in a circle: {_circles(edges, keys)}") from e
        raise
    return rows.join(_small(heights), [*keys, "from"], "left").select(*[c for c in arcs.columns if c != "seq"], F.coalesce("seq", F.lit(0)).alias("seq"))


def _circles(edges: DataFrame, keys: list[str]) -> list[tuple]:
    """Up to ten totals that are on circles or between two of them: what is left when arcs from no total or to no total are taken off again and again."""
    n = edges.count()
    while True:
        down, up = edges.select(*keys, F.col("from").alias("to")).distinct(), edges.select(*keys, F.col("to").alias("from")).distinct()
        edges = cut(edges.join(down, [*keys, "to"], "left_semi").join(up, [*keys, "from"], "left_semi"))
        left = edges.count()
        if left == n:
            return sorted((tuple(r) for r in edges.select(*keys, "from").distinct().limit(10).collect()), key=str)
        n = left


def arc_join(figures: DataFrame, arcs: DataFrame, keys: list[str]) -> DataFrame:
    """Figures with `equations`: (from, weight) of the equations that they are components of, or null."""
    a = arcs.groupBy(*keys, F.col("to").alias("tag")).agg(F.collect_list(F.struct("from", "weight")).alias("equations"))
    return figures.join(_small(a), [*keys, "tag"], "left")


def arc_weighted_sum(components: DataFrame, keys: list[str], *, keep_original_first: bool = True) -> DataFrame:
    """Components (arc_join) and their computed totals, one row per (adsh, tag).

    A total is the sum of weight * value of what components there are, 0 where all are null, and instant if all are. Where it is
    there already, the original or the computed row stays. Rows are grouped by adsh at least, so this shuffles nothing
    that is partitioned by adsh.
    """
    held = [*VALUES, "is_computed", "is_instant"]
    itself = F.struct(F.lit(True).alias("own"), F.lit(None).cast("string").alias("from"), F.lit(None).cast("double").alias("weight"))
    parts = F.transform("equations", lambda x: F.struct(F.lit(False).alias("own"), x["from"].alias("from"), x["weight"].cast("double").alias("weight")))
    each = components.withColumn("__e", F.explode(F.coalesce(F.concat(F.array(itself), parts), F.array(itself))))
    own = F.col("__e.own")
    each = each.withColumns({"__own": F.when(own, F.struct(*held)), "__tag": F.when(own, F.col("tag")).otherwise(F.col("__e.from"))})
    sums = [F.coalesce(F.sum(F.when(~own, F.col(c) * F.col("__e.weight"))), F.lit(0.0)).alias(c) for c in VALUES]
    totals = each.groupBy("adsh", *keys, F.col("__tag").alias("tag")).agg(F.min("__own").alias("__own"), F.count_if(~own).alias("__n"), *sums, F.coalesce(F.bool_and(F.when(~own, F.col("is_instant"))), F.lit(False)).alias("is_instant"))
    made = F.struct(*VALUES, F.lit(True).alias("is_computed"), "is_instant")
    best = F.coalesce("__own", made) if keep_original_first else F.when(F.col("__n") > 0, made).otherwise(F.col("__own"))
    return totals.select("adsh", *keys, "tag", best.alias("__b")).select("adsh", *keys, "tag", *[F.col(f"__b.{c}").alias(c) for c in held])


def keep_first_by_priority(first: DataFrame, second: DataFrame) -> DataFrame:
    """The rows of `first`, and those of `second` whose (adsh, tag) is not in it; one row per key."""
    both = first.withColumn("__prio", F.lit(1)).unionByName(second.withColumn("__prio", F.lit(2)), allowMissingColumns=True)
    order = Window.partitionBy("adsh", "tag").orderBy("__prio", *[F.col(c) for c in first.columns if c not in ("adsh", "tag")])
    return both.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n", "__prio")


def _by_filing(figures: DataFrame) -> tuple[DataFrame, int | None]:
    """Figures partitioned by filing, and into how many partitions: as many as keep to FIGURES_A_TASK, or as Spark chooses where those would be few."""
    n = -(-figures.count() // FIGURES_A_TASK)
    n = n if n > figures.sparkSession.sparkContext.defaultParallelism else None
    return _spread(figures, n), n


def _spread(figures: DataFrame, n: int | None) -> DataFrame:
    return figures.repartition(n, "adsh") if n else figures.repartition("adsh")


def _apply(figures: DataFrame, n: int | None, arcs: DataFrame, keys: list[str], keep_original_first: bool, max_passes: int, across: bool) -> DataFrame:
    """Levels over figures that are partitioned by filing (_by_filing)."""
    columns = [*keys, "adsh", "tag", *VALUES, "is_computed", "is_instant"]
    arcs = cut(arcs.select(*keys, "seq", "from", "to", "weight"))
    if across:
        arcs = cut(arcs.dropDuplicates([*keys, "seq", "from", "to"]))
    levels = [r["seq"] for r in arcs.select("seq").distinct().orderBy("seq").collect()]
    out = figures.select(*columns)
    for k in range(max_passes * len(levels)):
        out = arc_weighted_sum(arc_join(out, arcs.where(F.col("seq") == levels[k % len(levels)]), keys), keys, keep_original_first=keep_original_first).select(*columns)
        if k % CUT_LEVELS == CUT_LEVELS - 1:
            out = _spread(cut(out), n)
    return out


def apply_arcs(figures: DataFrame, arcs: DataFrame, *, keep_original_first: bool = True, max_passes: int = 1, dedupe_across_statements: bool = False) -> DataFrame:
    """Missing totals computed from their components, level by level. An original without a value still blocks a computed row.

    An equation that two statements share counts twice unless dedupe_across_statements.
    """
    require_columns(figures, ["adsh", "tag", *VALUES], "figures")
    require_columns(arcs, ["seq", "from", "to", "weight"], "arcs")
    rows, n = _by_filing(_with_flags(figures))
    return _apply(rows, n, arcs, [], keep_original_first, max_passes, dedupe_across_statements)


def _with_flags(figures: DataFrame) -> DataFrame:
    for name in ("is_computed", "is_instant"):
        if name not in figures.columns:
            figures = figures.withColumn(name, F.lit(False))
    return figures


def attach_version(figures: DataFrame, sub: DataFrame) -> DataFrame:
    return figures.join(sub.groupBy("adsh").agg(F.max(F.coalesce("version", F.lit(0))).cast("int").alias("version")), "adsh")


def apply_arcs_by_version(figures: DataFrame, sub: DataFrame, arcs: DataFrame, *, keep_original_first: bool = True, max_passes: int = 1, dedupe_across_statements: bool = False) -> DataFrame:
    """apply_arcs with the arcs of each filing's taxonomy year. Filings without metadata are dropped, years without arcs pass through."""
    require_columns(sub, ["adsh", "version"], "submissions")
    require_columns(arcs, ["version", "seq", "from", "to", "weight"], "arcs")
    rows, n = _by_filing(_with_flags(figures))
    versions = sub.select("adsh", "version")
    return _apply(attach_version(rows, _spread(versions, n) if n else versions), n, arcs.withColumn("version", F.col("version").cast("int")), ["version"], keep_original_first, max_passes, dedupe_across_statements).drop("version")


def equation_terms(arcs: DataFrame) -> DataFrame:
    return arcs.groupBy("version", "statement", "from").agg(F.count("*").alias("n_terms"))


def equation_predict(figures: DataFrame, arcs: DataFrame, value_col: str) -> DataFrame:
    """pred (null without any component) and n_present per (adsh, version, statement, from)."""
    a = arcs.select("version", "statement", "from", F.col("to").alias("tag"), "weight")
    src = figures.select("adsh", "version", "tag", F.col(value_col).alias("x")).join(_small(a), ["version", "tag"])
    return src.groupBy("adsh", "version", "statement", "from").agg(F.sum(F.col("x") * F.col("weight")).alias("pred"), F.count("x").alias("n_present"))


def equation_stats(figures: DataFrame, arcs: DataFrame, value_col: str, *, rtol: float, atol: float, require_full_sources: bool) -> DataFrame:
    """n_terms, n_tests, n_fail, fail_rate per (version, statement, from); figures with version."""
    totals = figures.select("adsh", "version", F.col("tag").alias("from"), F.col(value_col).alias("y"))
    test = equation_predict(figures, arcs, value_col).join(totals, ["adsh", "version", "from"]).join(_small(equation_terms(arcs)), ["version", "statement", "from"])
    test = test.where("y is not null and pred is not null")
    if require_full_sources:
        test = test.where("n_present = n_terms")
    fails = F.abs(F.col("pred") - F.col("y")) > atol + rtol * F.greatest(F.lit(1.0), F.abs("y"))
    return test.groupBy("version", "statement", "from").agg(F.max("n_terms").alias("n_terms"), F.count("*").alias("n_tests"), F.count_if(fails).alias("n_fail")).withColumn("fail_rate", F.col("n_fail") / F.col("n_tests"))


def filter_unreliable_arcs(figures: DataFrame, sub: DataFrame, arcs: DataFrame, *, value_col: str = "reported_figure", min_tests: int = 50, max_fail_rate: float = 0.05, rtol: float = 1e-5, atol: float = 1e-4, require_full_sources: bool = True, universe: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(arcs, stats): the arcs of equations that hold in at least min_tests filings; all arcs if no equation qualifies.

    Arcs with an end outside the tag universe (by default the tags of figures) go before terms are counted.
    """
    require_columns(figures, ["adsh", "tag", value_col], "figures")
    require_columns(arcs, ["version", "statement", "from", "to", "weight"], "arcs")
    known = filter_arcs_to_universe(arcs.where(F.col("statement").isNotNull() & F.col("from").isNotNull() & F.col("to").isNotNull()), universe if universe is not None else figures.select("tag"))
    known = cut(known.withColumn("version", F.coalesce(F.col("version").cast("int"), F.lit(0))))
    stats = cut(equation_stats(attach_version(figures.select("adsh", "tag", value_col), sub), known, value_col, rtol=rtol, atol=atol, require_full_sources=require_full_sources))
    keep = stats.where((F.col("n_tests") >= min_tests) & (F.col("fail_rate") <= max_fail_rate)).select("version", "statement", "from")
    if keep.isEmpty():
        return arcs, stats
    return known.join(keep, ["version", "statement", "from"], "left_semi").select(*arcs.columns), stats


def component_signature(arcs: DataFrame) -> DataFrame:
    """The sorted components of each equation."""
    return arcs.groupBy(*EQUATION).agg(F.array_sort(F.collect_set("to")).alias("signature"))


def dense_renumber_seq(arcs: DataFrame) -> DataFrame:
    """seq as 0, 1, 2, ... per version."""
    return arcs.withColumn("seq", (F.dense_rank().over(Window.partitionBy("version").orderBy("seq")) - 1).cast("int"))


def _first_arc(arcs: DataFrame) -> DataFrame:
    return arcs.groupBy(*EQUATION, "to").agg(F.min("weight").alias("weight"))


def expand_arcs(arcs: DataFrame, *, pivot_weights: tuple[float, ...] = (1.0, -1.0), enforce_signature_unique_seq: bool = True, renumber_seq: bool = True, max_bump_iters: int = MAX_BUMPS) -> DataFrame:
    """Arcs with every equation also solved for each component of weight 1 or -1, one seq later.

    Equations of one seq with the same components but different totals are spread over the following seqs.
    """
    columns = ["version", "statement", "seq", "from", "to", "weight"]
    require_columns(arcs, columns, "arcs")
    base = _first_arc(arcs.select(*columns).where(F.col("statement").isNotNull() & F.col("from").isNotNull() & F.col("to").isNotNull()))
    solved = base.where(F.col("weight").isin(*pivot_weights)).select(*EQUATION, F.col("to").alias("k"), F.col("weight").alias("w_k"))
    total = solved.select("version", "statement", F.col("seq") + 1, F.col("k"), F.col("from"), F.col("w_k"))
    others = solved.join(base, list(EQUATION)).where("`to` <> k").select("version", "statement", F.col("seq") + 1, F.col("k"), F.col("to"), -F.col("weight") / F.col("w_k"))
    out = cut(_first_arc(base.select(*columns).union(_first_arc(total.union(others).toDF(*columns)).select(*columns))).select(*columns))
    for _ in range(max_bump_iters if enforce_signature_unique_seq else 0):
        clash = Window.partitionBy("version", "statement", "seq", "signature").orderBy("from")
        moved = cut(component_signature(out).withColumn("__bump", F.row_number().over(clash) - 1).where("__bump > 0").select(*EQUATION, "__bump"))
        if moved.isEmpty():
            break
        out = cut(out.join(moved, list(EQUATION), "left").withColumn("seq", F.col("seq") + F.coalesce("__bump", F.lit(0))).select(*columns))
    else:
        if enforce_signature_unique_seq:
            raise RuntimeError(f"seq collisions remain after {max_bump_iters} rounds")
    return (dense_renumber_seq(out) if renumber_seq else out).select(*columns)


def compute_missing_with_arcs(figures: DataFrame, sub: DataFrame, arcs: DataFrame, *, universe: DataFrame | None = None, filter_arcs: bool = True, expand: bool = True, refilter: bool = True, min_tests: int = 5, max_fail_rate: float = 0.1, keep_original_first: bool = True, max_passes: int = 1) -> DataFrame:
    """Filter the arcs, expand them, filter again, apply; each step can be left out."""
    arcs = filter_arcs_to_universe(arcs, universe if universe is not None else figures.select("tag").union(arcs.select("from")).union(arcs.select("to")).toDF("tag"))
    known = universe if universe is not None else arcs.select(F.col("from").alias("tag")).union(arcs.select("to")).union(figures.select("tag"))
    if filter_arcs:
        arcs, _ = filter_unreliable_arcs(figures, sub, arcs, min_tests=min_tests, max_fail_rate=max_fail_rate, universe=known)
    if expand:
        arcs = expand_arcs(arcs)
        if refilter:
            arcs, _ = filter_unreliable_arcs(figures, sub, arcs, min_tests=min_tests, max_fail_rate=max_fail_rate, universe=known)
    return apply_arcs_by_version(figures, sub, arcs, keep_original_first=keep_original_first, max_passes=max_passes)
