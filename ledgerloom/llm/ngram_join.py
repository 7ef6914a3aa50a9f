"""Exact Jaccard join on word n-grams: rare-first prefix filtering with length, positional and suffix filters.

All n-grams are put in one order, rare ones first. If two sets of n_x and n_y n-grams have a similarity of t, they share
one among the first n - ceil(t n) + 1 of each, their prefixes; so only n-grams of prefixes are joined. An n-gram that a single
class of equal sets has (most of a usual text) is in front of all others and can't be shared, so it is only counted:
a document with enough n-grams of its own has nothing left in its prefix and drops out.

Order. The n-grams of a block of documents, 64-bit hashes, are dealt to parts by their first bits; a part counts what it gets
by 32 more bits (its slots) and tells each block which slots are shared, and by how many. A slot that many documents of
a block share is sent to its part once, and the documents that have it go straight to where the block is put together
again, so that the work of a part does not grow with the documents of a hot n-gram but with blocks. Slots stand for their n-grams in the order;
two n-grams of one slot only make a prefix meet more.

Join. A prefix n-gram's list holds the classes that have it in their prefix. Each class is compared with the list's most
central class only (see near_dup), and all other links that join components are found by a second rare-first prefix
join over the differences from it: so a group of near copies, all of which meet in many lists, costs its members and not
its pairs, and a class pair is verified once, whatever number of lists it meets in. Pairs of lists that hold nothing else
are held to three bounds before their sets are read:
* length: the smaller set has at least t times the n-grams of the larger;
* position: what both sets can share before and after the place where they meet is enough;
* suffix: the two sets are cut at CUTS fixed hashes; the differences of the numbers of n-grams in each piece add up to no more than the
  difference that similar sets may have.

Nulls, empty texts and texts without words have no n-grams, link with nothing and are their own component. A text with
fewer words than an n-gram is one n-gram. Repeated rows are equal sets. A null id is never the smallest of a
component that has another. Ties in the order go to the hash and change no result. An empty table gives an empty
result. Other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._base import WordHashes, utf8, written
from .near_dup import _class_of, _small, component_rows, linked_classes, shingle_set

#: Pieces of the suffix filter, by the first bits of a hash.
CUTS = 16
#: N-grams of a part, on average; documents and n-grams of a block, at most (a longer document is a block by itself).
PART_GRAMS, BLOCK_DOCS, BLOCK_GRAMS = 1_000_000, 1000, 1_000_000
#: A slot in this many documents of a block is sent to its part once.
HOT = 16
#: Kinds of rows of a block: its documents, the documents of its hot slots. Others have the number of their part.
_DOCS, _HOT = -1, -2


def _features(n: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in rows:
            sizes, cids, cuts = [], [], []
            for text in utf8(batch, 1):
                s = shingle_set(text, n, hashes)
                sizes.append(len(s))
                cids.append(_class_of(s))
                cuts.append(np.bincount((s >> np.uint64(60)).astype(np.int64), minlength=CUTS) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(cids, pa.int64()), pa.array(cuts, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "cid", "cuts"])

    return run


_POSTINGS = "block long, part long, data binary"


def _packed(*arrays: np.ndarray) -> bytes:
    return np.array([len(a) for a in arrays], np.int64).tobytes() + b"".join(a.tobytes() for a in arrays)


def _unpacked(data: bytes, *kinds) -> list[np.ndarray]:
    sizes, at, out = np.frombuffer(data, np.int64, len(kinds)), 8 * len(kinds), []
    for n, kind in zip(sizes, kinds, strict=True):
        out.append(np.frombuffer(data, kind, n, at))
        at += int(n) * np.dtype(kind).itemsize
    return out


def _block(sets: list[np.ndarray], cids: list[int], bits: int) -> list[tuple]:
    """The rows of a block of distinct sets: one for each part that it has n-grams of, one for its documents, one for its hot slots."""
    import xxhash

    named = np.array(cids, np.int64)
    block = np.int64(np.uint64(xxhash.xxh3_64_intdigest(named.tobytes())))
    grams = np.concatenate(sets)
    doc = np.repeat(np.arange(len(sets), dtype=np.uint16), [len(s) for s in sets])
    part = (grams >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(grams), np.int64)
    low = grams.astype(np.uint32)
    order = np.lexsort((doc, low, part))
    part, low, doc = part[order], low[order], doc[order]
    first = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (low[1:] != low[:-1])])
    n = np.diff(np.r_[first, len(low)])
    hot = n >= HOT
    cold = ~np.repeat(hot, n)
    out = [(block, _DOCS, _packed(named, np.array([len(s) for s in sets], np.int64)))]
    out.append((block, _HOT, _packed(part[first[hot]], low[first[hot]], n[hot], doc[~cold])))
    at, hot_at = np.searchsorted(part, np.arange(2**bits + 1)), np.searchsorted(part[first[hot]], np.arange(2**bits + 1))
    for k in np.unique(part):
        own, heat = slice(at[k], at[k + 1]), slice(hot_at[k], hot_at[k + 1])
        keep = cold[own]
        out.append((block, int(k), _packed(low[own][keep], doc[own][keep], low[first[hot][heat]], n[hot][heat].astype(np.uint32))))
    return out


def _postings(n: int, bits: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()

        def put(sets: dict[int, np.ndarray]) -> pa.RecordBatch:
            found = _block(list(sets.values()), list(sets), bits)
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in found], pa.int64()), pa.array([r[1] for r in found], pa.int64()), pa.array([r[2] for r in found], pa.binary())], names=["block", "part", "data"])

        sets, size = {}, 0
        for batch in rows:
            for text in utf8(batch, 0):
                s = shingle_set(text, n, hashes)
                cid = _class_of(s)
                if cid is None or cid in sets:
                    continue
                sets[cid] = s
                size += len(s)
                if len(sets) >= BLOCK_DOCS or size >= BLOCK_GRAMS:
                    yield put(sets)
                    sets, size = {}, 0
        if sets:
            yield put(sets)

    return run


def _count(table: pa.Table) -> pa.Table:
    """Of the rows of one part: for each block its shared cold n-grams with their document and number of classes, and the numbers of its hot slots."""
    rows = [_unpacked(d.as_py(), np.uint32, np.uint16, np.uint32, np.uint32) for d in table.column("data")]
    lows = np.concatenate([x for r in rows for x in (r[0], r[2])] or [np.empty(0, np.uint32)])
    weights = np.concatenate([x for r in rows for x in (np.ones(len(r[0]), np.int64), r[3].astype(np.int64))] or [np.empty(0, np.int64)])
    slots, of = np.unique(lows, return_inverse=True)
    df = np.bincount(of, weights=weights, minlength=len(slots)).astype(np.int64) if len(lows) else np.empty(0, np.int64)
    out, at = [], 0
    for low, doc, hot_low, _ in rows:
        own, heat = df[of[at : at + len(low)]], df[of[at + len(low) : at + len(low) + len(hot_low)]]
        at += len(low) + len(hot_low)
        keep = own > 1
        out.append(_packed(low[keep], doc[keep], own[keep], hot_low, heat))
    return pa.table({"block": table.column("block"), "part": table.column("part"), "data": pa.array(out, pa.binary())})


def _prefixes(percent: int):
    def run(table: pa.Table) -> pa.Table:
        """Of the rows of one block: what is shared of each document's prefix."""
        kinds = {int(k): d.as_py() for k, d in zip(table.column("part"), table.column("data"), strict=True) if k.as_py() < 0}
        if set(kinds) != {_DOCS, _HOT}:
            raise ValueError("a block came in pieces of different runs")
        cids, sizes = _unpacked(kinds[_DOCS], np.int64, np.int64)
        hot_part, hot_low, hot_n, hot_doc = _unpacked(kinds[_HOT], np.int64, np.uint32, np.int64, np.uint16)
        hot_df = np.zeros(len(hot_low), np.int64)
        part, low, doc, df = [], [], [], []
        for k, d in zip(table.column("part").to_pylist(), table.column("data"), strict=True):
            if k < 0:
                continue
            a, b, c, hot, heat = _unpacked(d.as_py(), np.uint32, np.uint16, np.int64, np.uint32, np.int64)
            part.append(np.full(len(a), k, np.int64))
            low.append(a)
            doc.append(b)
            df.append(c)
            lo, hi = np.searchsorted(hot_part, [k, k + 1])
            if hi - lo != len(hot):
                raise ValueError("a block came in pieces of different runs")
            hot_df[lo:hi] = heat
        part = np.concatenate([*part, np.repeat(hot_part, hot_n)])
        low = np.concatenate([*low, np.repeat(hot_low, hot_n)])
        doc = np.concatenate([*doc, hot_doc]).astype(np.int64)
        df = np.concatenate([*df, np.repeat(hot_df, hot_n)])
        order = np.lexsort((low, part, df, doc))
        part, low, doc = part[order], low[order], doc[order]
        shared = np.bincount(doc, minlength=len(cids))
        own = sizes - shared
        length = sizes + (-percent * sizes // 100) + 1  # n - ceil(t n) + 1
        rank = np.arange(len(doc)) - np.repeat(np.cumsum(shared) - shared, shared) + own[doc]
        keep = rank < length[doc]
        key = (part[keep] << 32) | low[keep].astype(np.int64)
        return pa.table({"key": pa.array(key, pa.int64()), "cid": pa.array(cids[doc[keep]], pa.int64()), "n": pa.array(sizes[doc[keep]], pa.int64()), "pos": pa.array(rank[keep], pa.int64())})

    return run


def prefix_entries(docs: DataFrame, classes: DataFrame, *, shingle: int, percent: int) -> DataFrame:
    """(key, cid, n, pos): the shared n-grams in the prefix of each class, named by their slot, and their place in the order."""
    total = classes.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    bits = max(4, int(total // PART_GRAMS).bit_length())
    no_id = F.lit(-(2**63))
    ids = written(classes.select(F.coalesce("low", no_id).alias("doc_id")).distinct(), "ids")
    few = _small(ids)
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), no_id).alias("doc_id"), "text").join(few, "doc_id", "left_semi")
    if few is ids:  # shuffled rows come in any order; blocks must be the same in every run of a task
        texts = texts.withColumn("__h", F.xxhash64("text")).sortWithinPartitions("doc_id", "__h", "text").drop("__h")
    rows = texts.select("text").mapInArrow(_postings(shingle, bits), _POSTINGS)
    dealt = written(rows, "postings")
    told = dealt.where("part >= 0").groupBy("part").applyInArrow(_count, _POSTINGS)
    return dealt.where("part < 0").unionByName(told).groupBy("block").applyInArrow(_prefixes(percent), "key long, cid long, n long, pos long").distinct()


def similar_sets(docs: DataFrame, *, shingle: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs (doc_id, text); component_id is the smallest id reachable by links."""
    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_features(shingle), "doc_id long, n_shingles long, cid long, cuts array<long>")
    rows = written(rows, "features")
    classes = written(rows.where("cid is not null").groupBy("cid").agg(F.min("doc_id").alias("low"), F.count("*").alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("cuts").alias("cuts")), "classes")
    entries = written(prefix_entries(docs, classes, shingle=shingle, percent=percent), "prefixes")
    met = written(entries.join(entries.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "key"), "lists")
    central = met.groupBy("cid").agg(F.sum("size").alias("score"))
    heads = met.join(central, "cid").groupBy("key").agg(F.max(F.struct("score", "cid", "n", "pos")).alias("h"))
    heads = written(heads.select("key", F.col("h.cid").alias("head"), F.col("h.n").alias("n_head"), F.col("h.pos").alias("pos_head")), "heads")
    pairs = met.join(heads, "key").where("cid <> head").select("head", "cid", (F.col("size") > 2).alias("shared"), _may_link(percent).alias("near"), "n", "n_head")
    pairs = written(pairs.groupBy("head", "cid").agg(F.max("shared").alias("shared"), F.max("near").alias("near"), F.first("n").alias("n"), F.first("n_head").alias("n_head")).where("shared or near"), "pairs")
    cut = lambda k, c: classes.select(F.col("cid").alias(k), F.col("cuts").alias(c))
    apart = F.aggregate(F.zip_with("a", "b", lambda x, y: F.abs(x - y)), F.lit(0).cast("long"), lambda s, x: s + x)
    pairs = pairs.join(cut("head", "a"), "head").join(cut("cid", "b"), "cid").where(F.col("shared") | ((100 + percent) * apart <= (100 - percent) * (F.col("n") + F.col("n_head"))))
    pairs = written(pairs.select("head", "cid", "shared"), "candidates")
    out = component_rows(rows.select("doc_id", "n_shingles", "cid"), classes, linked_classes(docs, classes, pairs, shingle, percent), keep=())
    return out.select("doc_id", "n_shingles", "component_id")


def _may_link(percent: int) -> Column:
    """Length and positional filter of a class and a head that meet at pos and pos_head."""
    small, large = F.least("n", "n_head"), F.greatest("n", "n_head")
    # n-grams before the meeting, itself, and after it; one more, as two n-grams of one slot may have changed places
    most = F.least("pos", "pos_head") + 2 + F.least(F.col("n") - F.col("pos"), F.col("n_head") - F.col("pos_head")) - 1
    return (100 * small >= percent * large) & ((100 + percent) * most >= percent * (F.col("n") + F.col("n_head")))


ORACLE = """
WITH RECURSIVE d AS (SELECT row_number() OVER () AS row, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
s AS (SELECT row, doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' ')) END) AS g FROM d),
sets AS (SELECT g, min(row) AS id, len(g) AS n FROM (SELECT row, list_sort(g) AS g FROM s WHERE len(g) > 0) GROUP BY g),
each AS (SELECT id, n, unnest(g) AS x FROM sets),
pairs AS (SELECT a.id AS x, b.id AS y FROM each a JOIN each b ON a.x = b.x AND a.id < b.id GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
arcs AS (SELECT x, y FROM pairs UNION SELECT y, x FROM pairs UNION SELECT id, id FROM sets),
reach AS (SELECT x, y FROM arcs UNION SELECT r.x, a.y FROM reach r JOIN arcs a ON r.y = a.x),
of AS (SELECT s.row, s.doc_id, sets.id FROM s JOIN sets ON list_sort(s.g) = sets.g),
low AS (SELECT r.x, min(o.doc_id) AS low FROM reach r JOIN of o ON r.y = o.id GROUP BY r.x)
SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, coalesce(low.low, s.doc_id) AS component_id FROM s LEFT JOIN of ON s.row = of.row LEFT JOIN low ON of.id = low.x"""
