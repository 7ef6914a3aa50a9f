"""Benchmark decontamination with spaced seeds.

A seed is the hash of the tokens at the kept positions of a mask, so a substituted token under an ignored
position does not break it. Every window of every document is hashed under each mask and joined with the seeds
of the benchmark; around each hit the document and the item are laid side by side and compared token by token,
and the overlap counts if some stretch of WINDOW tokens (or the whole item, where it is shorter) agrees in at
least MIN_EQUAL of its positions.

Tokens are the lower-cased words of whole texts, cut at white space and ASCII punctuation, so that marks put between
or after words don't hide a passage. The benchmark is dealt by a hash into blocks of about BLOCK_BYTES; the seeds of one
block at a time are sent to the tasks, where a sorted table of them (about 10 bytes a byte of text) meets every window of
every document. A benchmark of several blocks scans the documents as often; no text and no seed is shuffled.

A document of few words repeated over and over has as many hits as pairs of equal places. They are not listed: the shifts
between places of one seed come from a convolution where there are many, and alignments are compared in the order of their
lengths until none can be better, so time and memory grow with the lengths of both texts and not with their product.

Null and empty texts and items meet nothing, items without an id neither; an item shorter than a mask is a seed as a
whole. Documents with null or repeated ids give results of their own, each once per item; an item id with several texts
is several items. Ties between alignments go to the longest agreement, then the earliest. Empty tables give an empty
result. Other columns are not read.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._base import WordHashes, batches, mix64, utf8

MASKS = ("11010110011", "1100101011", "1011001101")
WINDOW, MIN_EQUAL = 13, 0.8
BLOCK_BYTES = 8_000_000
#: Hits that are listed at once (some 100 MB); a document with more is looked at item by item, by the shifts that its hits have.
SLICE = 2_000_000
_STEP = np.uint64(0x9E3779B97F4A7C15)

RESULT = "doc_id long, item_id long, n_equal long, n_overlap long, doc_start long, item_share double"


_CUT = bytes(32 if c < 128 and not chr(c).isalnum() else c for c in range(256))


def tokens_of(text: bytes) -> list[bytes]:
    return text.decode("utf-8", "replace").lower().encode().translate(_CUT).split()


def masks_for(lengths: set[int]) -> list[tuple[int, ...]]:
    """Kept offsets of each mask; a solid mask for each item length that is below the longest mask."""
    shaped = [tuple(i for i, c in enumerate(m) if c == "1") for m in MASKS]
    longest = max(map(len, MASKS))
    return shaped + [tuple(range(k)) for k in sorted(lengths) if 0 < k < longest]


def seeds(hashes: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """The seed of every window under a mask."""
    n = len(hashes) - mask[-1]
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, len(mask), np.uint64)
    for at in mask:
        out = out * _STEP + hashes[at : at + n]
    return mix64(out)


def overlap(doc: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int]:
    """(equal tokens, overlap length, start in the document) with item[0] laid at doc[shift]."""
    a, b = max(0, -shift), min(len(item), len(doc) - shift)
    window = min(WINDOW, len(item))
    if b - a < window:
        return 0, 0, 0
    equal = np.zeros(b - a + 1, np.int64)
    np.cumsum(doc[a + shift : b + shift] == item[a:b], out=equal[1:])
    good = np.flatnonzero(equal[window:] - equal[:-window] >= MIN_EQUAL * window)
    if not len(good):
        return 0, 0, 0
    edges = np.zeros(b - a + 1, np.int64)
    np.add.at(edges, good, 1)
    np.add.at(edges, good + window, -1)
    covered = np.cumsum(edges[:-1]) > 0
    same = (doc[a + shift : b + shift] == item[a:b]) & covered
    return int(same.sum()), int(covered.sum()), int(a + shift + good[0])


def best_overlap(doc: np.ndarray, item: np.ndarray, shifts: np.ndarray) -> tuple[int, int, int]:
    """The overlap() of the best of some shifts: most equal tokens, then the earliest start.

    Shifts go by the number of tokens that lie side by side, and the search ends where no more can be equal than have been found.
    """
    sides = np.minimum(len(item), len(doc) - shifts) - np.maximum(0, -shifts)
    best = (0, 0, 0)
    for i in np.lexsort((shifts, -sides)):
        side, shift = int(sides[i]), int(shifts[i])
        if side < max(best[0], 1):
            break
        if side == best[0] and max(0, shift) >= best[2]:
            continue
        best = max(best, overlap(doc, item, shift), key=lambda x: (x[0], -x[2]))
    return best


def differences(p: np.ndarray, q: np.ndarray, met: np.ndarray, zero: int) -> None:
    """Marks p - q + zero in `met` for all pairs; by a convolution where there are more pairs than that costs."""
    if len(p) * len(q) <= 64 * len(met):
        for at in range(0, len(q), max(1, SLICE // max(1, len(p)))):
            met[(p[:, None] - q[None, at : at + max(1, SLICE // max(1, len(p)))] + zero).ravel()] = True
        return
    size = 1 << (int(p[-1] - p[0]) + int(q[-1] - q[0]) + 1).bit_length()
    x, y = np.zeros(size), np.zeros(size)
    x[p - p[0]] = 1
    y[q[-1] - q] = 1
    found = np.flatnonzero(np.fft.irfft(np.fft.rfft(x) * np.fft.rfft(y), size) > 0.5)
    met[found + int(p[0]) - int(q[-1]) + zero] = True


class Seeds:
    """The seeds of a block of items (id, text), sorted, behind a bitmap of their first bits."""

    BITS = 20

    def __init__(self, items: list[tuple[int, bytes]]):
        hashes = WordHashes()
        self.ids = [i for i, _ in items]
        self.items = [hashes.of(tokens_of(t)) for _, t in items]
        self.tables = []
        for mask in masks_for({len(h) for h in self.items}):
            whole = len(mask) == mask[-1] + 1
            found = [seeds(h, mask) if not whole or len(h) == len(mask) else np.empty(0, np.uint64) for h in self.items]
            sizes = [len(f) for f in found]
            seed = np.concatenate(found) if found else np.empty(0, np.uint64)
            if not len(seed):
                continue
            item = np.repeat(np.arange(len(found), dtype=np.int32), sizes)
            place = np.arange(len(seed), dtype=np.int32) - np.repeat(np.cumsum(sizes) - sizes, sizes).astype(np.int32)
            order = np.argsort(seed, kind="stable")
            seed = seed[order]
            bitmap = np.zeros(2**self.BITS, bool)
            bitmap[seed >> np.uint64(64 - self.BITS)] = True
            self.tables.append((mask, seed, item[order], place[order], bitmap))

    def met(self, hashes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each mask: the positions whose seed is here, and the rows of the mask's table with that seed, from lo to hi."""
        out = []
        for mask, seed, _, _, bitmap in self.tables:
            own = seeds(hashes, mask)
            at = np.flatnonzero(bitmap[own >> np.uint64(64 - self.BITS)])
            lo, hi = np.searchsorted(seed, own[at], "left"), np.searchsorted(seed, own[at], "right")
            some = hi > lo
            out.append((at[some], lo[some], hi[some]))
        return out

    def hits(self, met: list) -> np.ndarray:
        """(position, item, position in the item) of every seed that is met, as rows."""
        out = [np.empty((0, 3), np.int64)]
        for (at, lo, hi), (_, _, item, place, _) in zip(met, self.tables, strict=True):
            n = hi - lo
            k = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
            out.append(np.stack([np.repeat(at, n), item[k], place[k]], axis=1))
        return np.concatenate(out)

    def shifts(self, met: list, length: int) -> Iterator[tuple[int, np.ndarray]]:
        """(item, distinct shifts) of one document, item by item, without listing its hits; memory for one item's shifts."""
        places: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for (at, lo, hi), (_, _, item, place, _) in zip(met, self.tables, strict=True):
            if not len(at):
                continue
            order = np.argsort(lo, kind="stable")
            cuts = np.flatnonzero(np.r_[True, lo[order][1:] != lo[order][:-1]])
            for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
                p, rows = at[order[a:b]], slice(lo[order[a]], hi[order[a]])
                own = item[rows]
                for i in np.unique(own):
                    places.setdefault(int(i), []).append((p, place[rows][own == i].astype(np.int64)))
        for i, pairs in places.items():
            zero = len(self.items[i])
            met_ = np.zeros(length + zero + 1, bool)
            for p, q in pairs:
                differences(p, q, met_, zero)
            yield i, np.flatnonzero(met_) - zero


_built: dict[str, Seeds] = {}


def _met(index: Seeds, tokens: list[np.ndarray]) -> Iterator[tuple[int, int, tuple[int, int, int]]]:
    """(document, item, best overlap) of some documents; one with more than SLICE hits is looked at by itself, without listing them."""
    starts = np.cumsum([0] + [len(t) for t in tokens])
    met = index.met(np.concatenate(tokens))
    if sum(int((hi - lo).sum()) for _, lo, hi in met) > SLICE:
        if len(tokens) > 1:
            half = len(tokens) // 2
            yield from _met(index, tokens[:half])
            for d, i, found in _met(index, tokens[half:]):
                yield d + half, i, found
        else:
            for i, shifts in index.shifts(met, len(tokens[0])):
                yield 0, i, best_overlap(tokens[0], index.items[i], shifts)
        return
    hits = index.hits(met)
    doc = np.searchsorted(starts, hits[:, 0], side="right") - 1
    # windows that reach into the next document are harmless: the comparison stays inside one document
    shifts = np.unique(np.stack([doc, hits[:, 1], hits[:, 0] - starts[doc] - hits[:, 2]], axis=1), axis=0)
    pair = np.flatnonzero(np.any(shifts[1:, :2] != shifts[:-1, :2], axis=1)) + 1
    for group in np.split(shifts, pair) if len(shifts) else ():
        d, i = int(group[0, 0]), int(group[0, 1])
        yield d, i, best_overlap(tokens[d], index.items[i], group[:, 2])


def _scan(name: str, block):
    """Looks for one block of items (a broadcast variable) in each document; a worker keeps the table it built last."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _built:
            _built.clear()
            _built[name] = Seeds(block.value)
        index, words = _built[name], WordHashes()
        for batch in batches(rows, 2000):
            ids = batch.column(0).to_pylist()
            tokens = [words.of(tokens_of(t)) for t in utf8(batch, 1)]
            found = [(ids[d], index.ids[i], *best, best[0] / len(index.items[i])) for d, i, best in _met(index, tokens) if best[0]] if any(map(len, tokens)) else []
            if found:
                yield _batch(found)

    return run


def _batch(found: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in RESULT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.float64() if n == "item_share" else pa.int64()) for n, c in zip(names, zip(*found, strict=True), strict=True)], names=names)


def contaminated(docs: DataFrame, benchmark: DataFrame, *, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document and benchmark item that overlap: doc_id, item_id, n_equal (equal tokens), n_overlap (tokens side by side), doc_start (token), item_share (of the item's tokens)."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long"), "text").where("item_id is not null and text is not null").distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n"), F.count("*").alias("rows")).first()
    blocks = max(1, min(size["rows"], -(-size["n"] // max(1, block_bytes))))
    out = []
    for k in range(blocks):
        known = sorted((r["item_id"], r["text"].encode()) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect())
        out.append(texts.mapInArrow(_scan(uuid.uuid4().hex, spark.sparkContext.broadcast(known)), RESULT))
    return functools.reduce(DataFrame.unionAll, out)
