"""MinHash near-duplicates with tensored banding.

Two small collections of band hashes, A and B, are computed per document, each band from two minhashes; a
table key is made of every pair (A_i, B_j), so 2*m band hashes give m*m tables and only a square root of the
minhashes that independent tables need. Candidates are verified on their full shingle sets, so every link is exact.

Equal sets collapse into one class first. In each table every class is compared with the table's head only, its most
central class (a star, linear in the table's size): the symmetric difference D of the two sets is computed, and they
are linked if it is small enough. No link that joins two components is lost to the star. Two sets x and y that were
compared with one head are similar only if their D share at least (|D_x| + |D_y| - c (|x| + |y|)) / 2 elements,
c = (100 - percent) / (100 + percent), and they can only join components if one of them isn't linked to the head. Sizes
of D rule out nearly all pairs; a prefix filter over the elements that several components share, rare ones first, finds
those that are left: classes are told apart by levels of cost, so that a prefix is as short as the level of the other
side allows, and pairs that meet must still have enough elements behind the place of meeting and in their bit
signatures. Their overlap in D, which gives their similarity exactly, decides. Near copies of the head cost their number
and not their pairs.

A class just too far from the head may be similar to hundreds of the head's near copies, and one such link is enough. So
before that join each such class is compared, by signatures, with TURNS[0] others of its head, drawn by a hash, then with
TURNS[1], and so on; verified links join components after each turn, and pairs inside one are not looked at again. A class
with many links is joined early on, so what the last join, which leaves out no pair, still finds are classes with few
links or none. Of the pairs of those that share a rare element, all are compared and nearly none is kept.

Of the pairs at exactly the threshold 0.8, about 1 in 2,000 meets in no table; nearly all others meet.

Nulls, empty texts and texts without words have no shingles, link with nothing and are their own component.
A text with fewer words than a shingle is one shingle. Repeated rows are exact copies of each other. A null id
is never the smallest of a component that has another; a component of null ids only has a null id. Ties between heads
go to the larger class hash and change no result. An empty table gives an empty result. Other columns of the input,
whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._base import WordHashes, mix64, utf8, written

#: Bands in each of the two collections, minhashes in a band.
BANDS, ROWS = 8, 2
#: 64-bit words of the signature of the elements of D that a class shares with others; a power of two.
WORDS = 8
#: Classes of a large group that those too far from its head are compared with, turn by turn, before all are.
TURNS = (64, 512, 4096)
#: Ids or classes up to this number are broadcast (16 MB); more are joined by shuffling.
BROADCAST_IDS = 1_000_000

_rng = np.random.default_rng(20240607)
_MINHASH = _rng.integers(1, 2**63, 2 * BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: bytes, n: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles of a whole text, A-Z lower-cased."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = hashes.of(words)
    k = min(n, len(words))
    out = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):
        out = out * _STEP + h[i : len(words) - k + 1 + i]
    return np.unique(mix64(out))


def _minima(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):
        product = shingles[at : at + 2048, None] * factors[None, :]
        product ^= product >> np.uint64(32)
        product *= _STEP
        np.minimum(least, product.min(axis=0), out=least)
    return least


def _bands(shingles: np.ndarray) -> np.ndarray:
    m = _minima(shingles, _MINHASH).reshape(2 * BANDS, ROWS)
    out = np.zeros(2 * BANDS, np.uint64)
    for r in range(ROWS):
        out = mix64(out * _STEP + m[:, r])
    return out.view(np.int64)


def _class_of(shingles: np.ndarray) -> int:
    import xxhash

    return np.int64(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes()))) if len(shingles) else None


_FEATURES = "doc_id long, n_shingles long, cid long, bands array<long>"


def _features(n: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, known = WordHashes(), {}
        for batch in rows:
            sizes, cids, bands = [], [], []
            for text in utf8(batch, 1):
                s = shingle_set(text, n, hashes)
                cid = _class_of(s)
                if cid is not None and cid not in known:
                    if len(known) > 20_000:
                        known.clear()
                    known[cid] = _bands(s)
                sizes.append(len(s))
                cids.append(cid)
                bands.append(known.get(cid))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(cids, pa.int64()), pa.array(bands, pa.list_(pa.int64())), *batch.columns[2:]],
                names=["doc_id", "n_shingles", "cid", "bands", *batch.schema.names[2:]],
            )

    return run


def _sets(n: int):
    """(cid, set) of each row; the set as its sorted 64-bit hashes."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in rows:
            texts = utf8(batch, 0)
            for at in range(0, len(texts), 256):
                sets = [shingle_set(t, n, hashes) for t in texts[at : at + 256]]
                yield pa.RecordBatch.from_arrays([pa.array([_class_of(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["cid", "shingles"])

    return run


def _differences(percent: int):
    """Of (head, cid, shared, set of the head, set): the size of the set, of the symmetric difference D, whether both are similar, and D itself where others share the table."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sizes, apart, linked = [], [], []
                for x, y in zip(part.column(3), part.column(4), strict=True):
                    a, b = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                    d = np.setxor1d(a, b, assume_unique=True).view(np.int64)
                    sizes.append(len(b))
                    apart.append(d)
                    linked.append((100 + percent) * len(d) <= (100 - percent) * (len(a) + len(b)))
                shared = part.column(2).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(sizes, pa.int64()), pa.array([len(d) for d in apart], pa.int64()), pa.array(linked, pa.bool_()), pa.array([d if s else None for d, s in zip(apart, shared, strict=True)], pa.list_(pa.int64()))],
                    names=["head", "cid", "shared", "n", "nd", "linked", "d"],
                )

    return run


def _past_the_star(apart: DataFrame, parts: DataFrame, percent: int) -> DataFrame | None:
    """(comp, whole): components that similar sets of one head join, although no link to a head does, and what they make together; None if there are none.

    Tables by head are written before they are joined, so that Spark can split the join at a head of many classes.
    """
    far, near = 100 + percent, 100 - percent
    of = lambda name, comp: parts.select(F.col("node").alias(name), F.col("comp").alias(comp))
    members = apart.where("shared").join(of("cid", "c"), "cid", "left").join(of("head", "h"), "head", "left")
    members = written(members.select("head", "cid", F.coalesce("c", "cid").alias("comp"), F.coalesce("h", "head").alias("head_comp"), "n", "nd", "d"), "members")
    split = written(members.groupBy("head").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a <> b").select("head"), "split")
    loose = members.join(split, "head")
    each = loose.select("head", "cid", "comp", F.explode("d").alias("e"))
    across = written(each.groupBy("head", "e").agg(F.min("comp").alias("a"), F.max("comp").alias("b"), F.count("*").alias("df")).where("a <> b").select("head", "e", "df"), "across")
    rarest = Window.partitionBy("head", "cid").orderBy("df", "e")
    shared = written(each.join(across, ["head", "e"]).select("head", "cid", "e", F.row_number().over(rarest).alias("rank")), "shared")
    # in units of 1 / (100 + percent): similar needs (cost(x) + cost(y)) / 2 shared elements, so cost(x) <= room(y)
    signature = [F.expr(f"bit_xor(if((shiftright(e, 6) & {WORDS - 1}) = {i}, shiftleft(1L, cast(e & 63 as int)), 0L)) as s{i}") for i in range(WORDS)]
    signed = [f"s{i}" for i in range(WORDS)]
    counts = shared.groupBy("head", "cid").agg(F.max("rank").cast("long").alias("u"), *signature)
    stats = loose.drop("d").join(counts, ["head", "cid"])
    stats = written(stats.select("head", "cid", "comp", "head_comp", "u", *signed, (far * F.col("nd") - near * F.col("n")).alias("cost"), (near * F.col("n") - far * (F.col("nd") - 2 * F.col("u"))).alias("room")), "stats")
    bounds = written(stats.groupBy("head").agg(F.max("room").alias("most"), F.min("cost").alias("least"), F.count("*").alias("size")), "bounds")
    level = F.floor(F.log2(1 + (F.col("cost") - F.col("least")) / (2 * far))).cast("int")
    known = written(stats.join(bounds, "head").where("cost <= most and least <= room").withColumn("level", level).drop("most", "least"), "known")
    cost = F.col("cost_x") + F.col("cost_y")
    # each bit of the signatures that differs is an element of one set only
    differ = sum((F.bit_count(F.col(f"{c}_x").bitwiseXOR(F.col(f"{c}_y"))) for c in signed), F.lit(0))
    enough = F.expr("comp_x <> comp_y and cost_x <= room_y and cost_y <= room_x") & (far * (F.col("u_x") + F.col("u_y") - differ) >= cost)
    apart_by = F.size("d_x") + F.size("d_y") - 2 * F.size(F.array_intersect("d_x", "d_y"))

    def named(rows: DataFrame, k: str, *more: str) -> DataFrame:
        own = (c for c in rows.columns if c not in ("head", "cid", "e", *more))
        return rows.select("head", F.col("cid").alias(k), *(c for c in ("e", *more) if c in rows.columns), *(F.col(c).alias(f"{c}_{k}") for c in own))

    def verified(met: DataFrame, name: str) -> DataFrame:
        """(x, y) components of the similar ones of the pairs met."""
        met = written(met.groupBy(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).agg(F.min("head").alias("head")), name)
        ids = written(met.select("head", F.col("x").alias("cid")).union(met.select("head", "y")).distinct(), "named")
        few = members.select("head", "cid", "comp", "n", "d").join(_small(ids), ["head", "cid"], "left_semi")
        pairs = met.join(named(few, "x"), ["head", "x"]).join(named(few, "y"), ["head", "y"])
        links = pairs.where(far * apart_by <= near * (F.col("n_x") + F.col("n_y"))).select(F.least("comp_x", "comp_y").alias("x"), F.greatest("comp_x", "comp_y").alias("y"))
        return written(links.distinct(), "more")

    found, whole = [], None
    for last, size in zip((0, *TURNS), TURNS, strict=False):
        large = known.where(F.col("size") > size)
        if large.isEmpty():
            break
        place = F.pmod(F.xxhash64("cid"), F.col("size"))
        links = verified(named(large.where("comp <> head_comp"), "x").join(named(large.where((place >= last) & (place < size)), "y"), "head").where(enough), f"candidates_{size}")
        if not links.isEmpty():
            found.append(links)
            whole = _joined(found)
            known = written(_relabelled(_relabelled(known, "comp", whole), "head_comp", whole).select(*known.columns), "known")

    # two sets that share k elements meet within the first size - k + 1 of each in any common order: rare elements first; k is the least that a level asks for
    first = F.col("rank") <= F.col("u") - F.greatest(F.lit(1), F.ceil((F.col("cost") + F.col("least")) / (2 * far))) + 1

    def placed(rows: DataFrame, partners: DataFrame, k: str, own: str, theirs: str) -> DataFrame:
        levels = partners.groupBy("head", F.col("level").alias(theirs)).agg(F.max("room").alias("most"), F.min("cost").alias("least"))
        met = rows.withColumnRenamed("level", own).join(levels, "head").where("cost <= most and least <= room").join(shared, ["head", "cid"]).where(first)
        return written(named(met.drop("most", "least", "size"), k, own, theirs), "placed")

    strays = known.where("comp <> head_comp")
    both = placed(strays, known, "x", "a", "b").join(placed(known, strays, "y", "b", "a"), ["head", "e", "a", "b"])
    # what is left from the place of meeting on must do, too
    rest = F.least(F.col("u_x") - F.col("rank_x"), F.col("u_y") - F.col("rank_y")) + 1
    links = verified(both.where(enough & (2 * far * rest >= cost) & F.expr("comp_y = head_comp_y or x < y")), "candidates")
    return whole if links.isEmpty() else _joined([*found, links])


def _joined(links: list[DataFrame]) -> DataFrame:
    """(comp, whole) of the components in tables of (x, y), marked for broadcasting if small."""
    joined = components(reduce(DataFrame.unionByName, links)).select(F.col("node").alias("comp"), F.col("comp").alias("whole"))
    return _small(written(joined, "whole"))


def _relabelled(rows: DataFrame, name: str, whole: DataFrame) -> DataFrame:
    return rows.join(whole.withColumnRenamed("comp", name), name, "left").withColumn(name, F.coalesce("whole", name)).drop("whole")


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of the nodes in `links` (x, y): comp is the smallest node reachable.

    Each round links every neighbour of a node to the smallest node around it (larger ones first, then smaller
    ones), which halves the depth of what is left, so rounds grow with the logarithm of the longest chain. Each
    round is written to the shared folder; only counts come to the driver.
    """
    edges = written(links.where("x != y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct(), "links")
    last = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that Spark can split the join at a node of many links
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = edges.select(F.col("v").alias("u"), F.col("u").alias("w")).join(least, "u").select(F.col("w").alias("u"), F.col("m").alias("v")).union(least.where("m != u").select("u", F.col("m").alias("v")))
        large = large.where("u != v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = written(large.join(small, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u != v").distinct(), "links")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last = state
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(roots)


def near_duplicates(docs: DataFrame, *, shingle: int = 5, percent: int = 80, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) and the columns named in `keep` for each row of docs (doc_id, text).

    Columns in `keep` must differ from the names above and from cid and bands.
    """
    schema = ", ".join([_FEATURES, *(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)])
    rows = written(docs.select(F.col("doc_id").cast("long"), "text", *keep).mapInArrow(_features(shingle), schema), "features")
    classes = written(rows.where("cid is not null").groupBy("cid").agg(F.min("doc_id").alias("low"), F.count("*").alias("copies"), F.first("bands").alias("bands")), "classes")
    tensor = F.flatten(F.transform(F.slice("bands", 1, BANDS), lambda a, i: F.transform(F.slice("bands", BANDS + 1, BANDS), lambda b, j: F.xxhash64(a, b, i, j))))
    keys = classes.select("cid", F.explode(tensor).alias("key"))
    met = written(keys.join(keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "key"), "tables")
    # the class that meets most others, counted over its tables, is the most central of a table
    central = met.groupBy("cid").agg(F.sum("size").alias("score"))
    heads = written(met.join(central, "cid").groupBy("key").agg(F.max(F.struct("score", "cid")).alias("h")).select("key", F.col("h.cid").alias("head")), "heads")
    pairs = written(met.join(heads, "key").where("cid <> head").groupBy("head", "cid").agg(F.max(F.col("size") > 2).alias("shared")), "pairs")
    return component_rows(rows.drop("bands"), classes, linked_classes(docs, classes, pairs, shingle, percent), keep)


def linked_classes(docs: DataFrame, classes: DataFrame, pairs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(node, comp) of the classes (cid, low) that are linked, of groups given as pairs (head, cid, shared); shared: the group has other members.

    Every link between members of a group that joins components is found, whether or not a head has part in it.
    """
    # the sets of the classes in `pairs`, read again from the text of the class's first document
    no_id = F.lit(-(2**63))
    ids = pairs.select("cid").union(pairs.select("head")).distinct().join(classes.select("cid", "low"), "cid").select(F.coalesce("low", no_id).alias("doc_id")).distinct()
    ids = written(ids, "ids")
    some = docs.select(F.coalesce(F.col("doc_id").cast("long"), no_id).alias("doc_id"), "text").join(_small(ids), "doc_id", "left_semi")
    sets = written(some.select("text").mapInArrow(_sets(shingle), "cid long, shingles binary").where("cid is not null").dropDuplicates(["cid"]), "sets")

    both = pairs.join(sets.select(F.col("cid").alias("head"), F.col("shingles").alias("set_head")), "head").join(sets, "cid").select("head", "cid", "shared", "set_head", "shingles")
    apart = written(both.mapInArrow(_differences(percent), "head long, cid long, shared boolean, n long, nd long, linked boolean, d array<long>"), "apart")
    parts = written(components(apart.where("linked").select(F.col("head").alias("x"), F.col("cid").alias("y"))), "parts")
    whole = _past_the_star(apart, parts, percent)
    if whole is not None:
        every = parts.unionByName(whole.select(F.col("comp").alias("node"), "comp").join(parts, "node", "left_anti"))
        parts = written(_relabelled(every, "comp", whole).select("node", "comp"), "parts")
    return parts


def component_rows(rows: DataFrame, classes: DataFrame, parts: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) and `keep` of rows (doc_id, n_shingles, cid), from classes (cid, low, copies) and linked_classes."""
    lows = parts.select(F.col("node").alias("cid"), "comp").join(classes.select("cid", "low"), "cid")
    least = written(lows.groupBy("comp").agg(F.min("low").alias("first")), "firsts")
    linked = written(lows.join(least, "comp").select("cid", "first"), "linked")
    # of all other classes only those with copies need a name
    named = written(linked.union(classes.where("copies > 1").join(linked, "cid", "left_anti").select("cid", "low")), "named")
    out = rows.join(_small(named), "cid", "left").withColumn("component_id", F.coalesce("first", "doc_id"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("doc_id").isNull() & F.col("component_id").isNull())
    return out.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), *keep)


def _small(table: DataFrame) -> DataFrame:
    """Marked for broadcasting if it has at most BROADCAST_IDS rows."""
    return F.broadcast(table) if table.count() <= BROADCAST_IDS else table
