"""Merkle manifest of a table of documents, with a proof for every row.

A leaf is the hash of a document's fields. Within a language the leaves stand in order of their ids; every FAN
consecutive nodes become one parent, level by level, until one node remains, the subroot; the subroots, in order of
their languages, become the root in the same way. Digests are lower-case hexadecimal SHA-256, and a parent is the digest of
its children's digests as text.

Every level is built by one grouping of the level below (an eighth of its rows) and stored as node rows: the children of
a node and the link to its own parent. A recursive query then climbs from the leaves: each step follows the parent link, appends
the siblings met there and folds the (possibly tampered) digest. The leaves of one node climb together, one row with
a lane for each, since all they meet above it is the same. Levels of more than BROADCAST_NODES nodes are climbed by shuffled joins
on the link, in which a node meets no more rows than its subtree has nodes below; the levels above, which all rows meet, are broadcast in
a second recursive query.

The place of a leaf is counted from a range-partitioned sort: places inside partitions, plus the number of rows of
the language in the partitions before, so that no language has to be in one task.

Null ids come first in their language and tie among themselves; ties go to the smaller leaf. A null language is one of its own and the first.
Null fields count as `-`. Repeated rows are leaves of their own. Empty texts are leaves like others. An empty table has an empty result. Other
columns are not read. A row without an id is tampered with (crc32 of nothing is 0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._base import written

FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Node rows of the upper levels, together, are broadcast up to this number (some 60 MB).
BROADCAST_NODES = 200_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _joined(digests: Column) -> Column:
    return F.array_join(F.transform(digests, _hex), "")


def leaf_text(fields: dict[str, Column]) -> Column:
    """What is hashed: each field as its number of bytes, a colon and its value, or as `-` where it is null."""
    return F.concat(*[F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in fields.values()])


def leaves_of(docs: DataFrame) -> DataFrame:
    """(lang, doc_id, leaf, tampered): digests of each row and of the row with A-Z of its text lower-cased, where the id's crc32 is a multiple of 3."""
    fields = {c: F.col(c) for c in FIELDS}
    changed = fields | {"text": F.translate("text", _UPPER, _LOWER)}
    hit = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 0
    leaf = _digest(leaf_text(fields))
    return docs.select("lang", F.col("doc_id").cast("long").alias("doc_id"), leaf.alias("leaf"), F.when(hit, _digest(leaf_text(changed))).alias("tampered"))


def placed(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """Rows with `place`: 0, 1, 2, ... within `group` by `order`."""
    dealt = written(rows.repartitionByRange(group, *order[:1]).sortWithinPartitions(group, *order).withColumn("__id", F.monotonically_increasing_id()), "sorted")
    part, own = F.shiftright("__id", 33), F.col("__id").bitwiseAND(F.lit(2**33 - 1))
    dealt = dealt.withColumns({"__part": part, "__own": own})
    spans = dealt.groupBy(group, "__part").agg(F.min("__own").alias("__first"), F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # one row per partition and group in it: no more than partitions and groups together
    spans = written(spans.select(F.col(group).alias("__g"), F.col("__part").alias("__p"), (before - F.col("__first")).alias("__shift")), "spans")
    small = F.broadcast(spans) if spans.count() <= BROADCAST_NODES else spans
    return dealt.join(small, dealt[group].eqNullSafe(F.col("__g")) & (F.col("__part") == F.col("__p"))).select(*rows.columns, (F.col("__own") + F.col("__shift")).alias("place"))


def _levels(nodes: DataFrame, tree: str) -> list[DataFrame]:
    """Tables (tree, level, pos, children, hash, last) of the parents of nodes (tree, pos, hash), level by level; last: only one node is left."""
    out, level = [], 0
    while True:
        level += 1
        run = F.array_sort(F.collect_list(F.struct("pos", "hash")))
        up = nodes.groupBy(tree, F.floor(F.col("pos") / FAN).cast("long").alias("up")).agg(run.alias("r"))
        sizes = nodes.groupBy(F.col(tree).alias("__t")).agg(F.max("pos").alias("__top")).where("__top > 0")
        sizes = written(sizes, "sizes")
        few = F.broadcast(sizes) if sizes.count() <= BROADCAST_NODES else sizes
        up = up.join(few, F.col(tree) == F.col("__t")).select(tree, F.lit(level).alias("level"), F.col("up").alias("pos"), F.col("r.hash").alias("children"), _digest(_joined(F.col("r.hash"))).alias("hash"), (F.col("__top") < FAN).alias("last"))
        up = written(up, "level")
        if up.isEmpty():
            return out
        out.append(up)
        nodes = up


def _climb(start: DataFrame, nodes: DataFrame) -> DataFrame:
    """Climbs from rows (lanes, folded, siblings, subroot, root, tree, level, pos, nth, above) by their links in `nodes` until no node is met there or the rest is above."""
    spark = start.sparkSession
    # folding a digest: the parent's children, with the digest in its own place
    before = "array_join(transform(slice(n.children, 1, c.nth), x -> lower(hex(x))), '')"
    after = f"array_join(transform(slice(n.children, c.nth + 2, {FAN}), x -> lower(hex(x))), '')"
    others = f"array_join(transform(concat(slice(n.children, 1, c.nth), slice(n.children, c.nth + 2, {FAN})), x -> hex(x)), '')"
    query = f"""
        WITH RECURSIVE climb(lanes, folded, siblings, subroot, root, tree, level, pos, nth, above) AS (
          SELECT lanes, folded, siblings, subroot, root, tree, level, pos, nth, above FROM {{start}}
          UNION ALL
          SELECT c.lanes, transform(c.folded, f -> unhex(sha2(concat({before}, lower(hex(f)), {after}), 256))), concat(c.siblings, unhex({others})),
                 if(n.tree >= 0, n.hash, c.subroot), n.hash, n.up_tree, n.up_level, n.up_pos, n.up_nth, n.up_above
          FROM climb c JOIN {{nodes}} n ON c.tree = n.tree AND c.level = n.level AND c.pos = n.pos
          WHERE NOT c.above)
        SELECT * FROM climb WHERE above OR tree IS NULL"""
    # the default stops at a million rows; a step has no more rows than the step before
    limit = spark.conf.get("spark.sql.cteRecursionRowLimit")
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    try:
        return written(spark.sql(query, start=start, nodes=nodes), "climbed")
    finally:
        spark.conf.set("spark.sql.cteRecursionRowLimit", limit)


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, leaf, subroot, root, proof, folded_root, verified) for each row of docs (FIELDS).

    proof: the siblings' digests (binary, one after another) from the leaf's own up to the root's.
    """
    rows = placed(written(leaves_of(docs), "leaves"), "lang", "doc_id", "leaf")
    rows = written(rows, "placed")
    langs = written(placed(rows.select("lang").distinct(), "lang", "lang").withColumn("one", F.lit(0)).drop("place"), "langs")
    # languages in order, as the trees 0, 1, 2, ...: a table of one row for each language
    langs = written(placed(langs, "one", "lang").select(F.col("lang").alias("__lang"), F.col("place").alias("tree")), "trees")
    n_langs = langs.count()
    few = F.broadcast(langs) if n_langs <= BROADCAST_NODES else langs
    rows = rows.join(few, rows["lang"].eqNullSafe(F.col("__lang"))).drop("__lang")

    lane = F.struct(F.col("place"), "doc_id", "lang", "leaf", F.coalesce("tampered", "leaf").alias("held"))
    runs = rows.groupBy("tree", F.floor(F.col("place") / FAN).cast("long").alias("pos")).agg(F.array_sort(F.collect_list(lane)).alias("lanes"))
    runs = written(runs, "runs")
    own = lambda c: F.transform("lanes", lambda x: x[c])
    sizes = written(runs.groupBy(F.col("tree").alias("__t")).agg(F.max(F.col("pos") * FAN + F.size("lanes")).alias("n")), "sizes")
    few = F.broadcast(sizes) if n_langs <= BROADCAST_NODES else sizes
    runs = runs.join(few, F.col("tree") == F.col("__t")).drop("__t")
    # the lowest nodes: parents of the leaves, or a leaf without others
    alone = F.col("n") == 1
    held = F.transform("lanes", lambda x, i: _digest(F.concat(_joined(F.slice(own("leaf"), F.lit(1), i)), _hex(x["held"]), _joined(F.slice(own("leaf"), i + 2, F.lit(FAN))))))
    base = written(runs.select("tree", "pos", "lanes", F.when(alone, own("held")).otherwise(held).alias("folded"), F.when(alone, own("leaf")[0]).otherwise(_digest(_joined(own("leaf")))).alias("hash"), (F.col("n") <= FAN).alias("last")), "base")

    inner = _levels(base.select("tree", "pos", "hash"), "tree")
    tops = base.where("last").select("tree", "hash")
    for up in inner:
        tops = tops.union(up.where("last").select("tree", "hash"))
    outer = _levels(written(tops, "subroots").select(F.lit(-1).cast("long").alias("tree"), F.col("tree").alias("pos"), "hash"), "tree")

    # links: to the next level of the tree, from a subroot to the tree of subroots, from the root to nothing
    counts = [(k, df, df.count()) for k, df in [*((1 + i, x) for i, x in enumerate(inner)), *((1 + i, x) for i, x in enumerate(outer))]]
    total, high = 0, set()
    for at in sorted(range(len(counts)), key=lambda i: counts[i][2]):
        total += counts[at][2]
        if total > BROADCAST_NODES:
            break
        high.add(at)
    levels_high = [F.lit(i in high) for i in range(len(counts))]

    def linked(df: DataFrame, level: int, outside: bool) -> DataFrame:
        """Rows (tree, pos, last) of a level with the link to the parent and whether that is in an upper level."""
        up = F.col("tree").isNotNull() & ~F.col("last")
        first_outer = len(inner)
        next_ = (first_outer if outside else 0) + level
        next_high = levels_high[next_] if next_ < len(counts) else F.lit(True)
        across = F.lit(bool(outer) and not outside) & F.col("last")
        pick = lambda a, b: F.when(up, a).when(across, b)
        return df.withColumns({
            "up_tree": pick(F.col("tree"), F.lit(-1)).cast("long"), "up_level": pick(F.lit(level + 1), F.lit(1)).cast("int"),
            "up_pos": pick(F.floor(F.col("pos") / FAN), F.floor(F.col("tree") / FAN)).cast("long"), "up_nth": pick(F.col("pos") % FAN, F.col("tree") % FAN).cast("int"),
            "up_above": F.coalesce(pick(next_high, levels_high[first_outer] if outer else F.lit(True)), F.lit(False)),
        })

    nodes = [linked(df, k, i >= len(inner)) for i, (k, df, _) in enumerate(counts)]
    columns = ["tree", "level", "pos", "children", "hash", "up_tree", "up_level", "up_pos", "up_nth", "up_above"]

    def of(some: list[int]) -> DataFrame | None:
        out = None
        for i in some:
            out = nodes[i].select(*columns) if out is None else out.union(nodes[i].select(*columns))
        return out

    start = linked(base, 0, False).select("lanes", "folded", F.lit(b"").alias("siblings"), F.col("hash").alias("subroot"), F.col("hash").alias("root"), F.col("up_tree").alias("tree"), F.col("up_level").alias("level"), F.col("up_pos").alias("pos"), F.col("up_nth").alias("nth"), F.col("up_above").alias("above"))
    low = of([i for i in range(len(counts)) if i not in high])
    if low is not None:
        start = _climb(start, low)
    if high:
        start = _climb(start.withColumn("above", F.lit(False)), F.broadcast(of(sorted(high)).withColumn("up_above", F.lit(False))))
    each = start.select("subroot", "root", "siblings", F.col("lanes.leaf").alias("leaves"), F.posexplode(F.arrays_zip("lanes", "folded")).alias("i", "x"))
    beside = F.concat(F.slice("leaves", F.lit(1), F.col("i")), F.slice("leaves", F.col("i") + 2, F.lit(FAN)))
    return each.select(
        F.col("x.lanes.doc_id").alias("doc_id"), F.col("x.lanes.lang").alias("lang"), F.col("x.lanes.leaf").alias("leaf"), "subroot", "root", F.concat(F.unhex(F.array_join(F.transform(beside, F.hex), "")), F.col("siblings")).alias("proof"),
        F.col("x.folded").alias("folded_root"), (F.col("x.folded") == F.col("root")).alias("verified"),
    )


def digest_rows(docs: DataFrame) -> DataFrame:
    """manifest() with digests as text and the digest of the proof instead of the proof."""
    rows = manifest(docs)
    text = lambda c: _hex(F.col(c)).alias(c)
    return rows.select("doc_id", text("leaf"), text("subroot"), text("root"), F.sha2(_hex(F.col("proof")), 256).alias("proof_sha256"), text("folded_root"), "verified")


_FIELD = "coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {v}, '-')"
ORACLE = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, {" || ".join(_FIELD.format(c=c, v=f"CAST({c} AS VARCHAR)") for c in FIELDS[:-1])} AS head, text,
         list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''), lambda c: CAST(ascii(c) AS BIGINT))),
           lambda a, b: list_reduce(list_prepend(xor(a, b), [CAST(x AS BIGINT) FOR x IN range(8)]), lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)) AS crc
  FROM documents),
l AS (
  SELECT doc_id, lang, sha256(head || {_FIELD.format(c="text", v="text")}) AS leaf,
         CASE WHEN xor(crc, 4294967295) % 3 = 0 THEN sha256(head || {_FIELD.format(c="text", v=f"translate(text, '{_UPPER}', '{_LOWER}')")}) ELSE sha256(head || {_FIELD.format(c="text", v="text")}) END AS held
  FROM d),
p AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, held) - 1 AS pos FROM l),
nodes AS (
  SELECT tree, 0 AS level, pos, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM p
  UNION ALL
  SELECT tree, any_value(level) + 1, pos // {FAN}, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + {FAN - 1}) // {FAN} FROM nodes WHERE n > 1 GROUP BY tree, pos // {FAN}),
subroots AS (SELECT tree, h FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, tree AS pos, h, (SELECT count(*) FROM subroots) AS n FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, pos // {FAN}, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + {FAN - 1}) // {FAN} FROM tops WHERE n > 1 GROUP BY pos // {FAN}),
every AS (SELECT tree, level, pos, h FROM nodes UNION ALL SELECT -1, level, pos, h FROM tops),
runs AS (SELECT tree, level, pos // {FAN} AS up, list(h ORDER BY pos) AS hs FROM every GROUP BY ALL),
climb AS (
  SELECT tree, 0 AS level, pos, row_number() OVER () AS id, doc_id, leaf, held AS folded, '' AS proof, tree AS own, 0 AS step FROM p
  UNION ALL
  SELECT CASE WHEN s.h IS NOT NULL THEN -1 ELSE c.tree END, CASE WHEN s.h IS NOT NULL THEN 0 ELSE c.level + 1 END, CASE WHEN s.h IS NOT NULL THEN c.tree ELSE c.pos // {FAN} END, c.id, c.doc_id, c.leaf,
         CASE WHEN s.h IS NOT NULL THEN c.folded ELSE sha256(array_to_string(list_transform(r.hs, lambda x, i: CASE WHEN i = c.pos % {FAN} + 1 THEN c.folded ELSE x END), '')) END,
         CASE WHEN s.h IS NOT NULL THEN c.proof ELSE c.proof || array_to_string(list_filter(r.hs, lambda x, i: i <> c.pos % {FAN} + 1), '') END, c.own, c.step + 1
  FROM climb c LEFT JOIN nodes s ON s.tree = c.tree AND s.level = c.level AND s.n = 1 LEFT JOIN runs r ON r.tree = c.tree AND r.level = c.level AND r.up = c.pos // {FAN}
  WHERE NOT (c.tree = -1 AND c.level = (SELECT max(level) FROM tops))),
done AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY step DESC) AS rk FROM climb),
root AS (SELECT h FROM tops WHERE n = 1)
SELECT doc_id, leaf, s.h AS subroot, root.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root.h AS verified
FROM done JOIN subroots s ON s.tree = done.own CROSS JOIN root WHERE rk = 1"""
