"""Phrase collocation mining with weighted acyclic automata.

For each language, phrases of two to MOST words that occur often enough are scored by how much more often the whole occurs
than its parts do, and the best are returned.

Counting. Orders are counted one after another, words first. A task reads a shard of some SHARD words, keeps the
n-grams whose shorter n-grams were frequent (a bitmap of fixed size tells; what it lets pass in vain is dropped later), sorts them, and
builds count transducers from them (see transducers), one for each prefix range. The transducers of a
range are united, weights summed, and what is frequent is kept as a transducer. Nothing that is frequent is ever dropped
before it is counted whole.

Ranges. N-grams are dealt by the first two bytes of their first word, in ranges of about RANGE words each; a prefix with more words
than that has several ranges, to which its n-grams are dealt by a hash, so hot words don't meet in one task. What a range gets is at most one weight
for each shard and n-gram.

Scoring. Each range asks the ranges of the parts of its candidates: the parts go there as an acceptor, which is
composed with the transducer there, and the weights come back in the acceptor's order. Scores are whole numbers of any
size.

Null and empty texts have no words; a null language is `und`. Repeated rows count again. Ties between phrases go to
the larger count, then to the smaller phrase in UTF-8 byte order; ties between cuts to the earlier cut. An
empty table gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._base import Index, hash64, mix64, numbered, utf8, written
from .transducers import Transducer, split, union

MOST, LEAST, TOP = 4, 30, 2000
#: A phrase goes if a longer one that holds it has this percentage of its occurrences.
HELD_PERCENT = 80
SCALE = 2_000_000
#: Words of a shard and of a range; bits of the bitmap (8 MB).
SHARD, RANGE, BITS = 2_000_000, 2_000_000, 26
#: Tables of one row for each language are broadcast up to this number.
BROADCAST_LANGS = 100_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MARK = b"."
_CUT = bytes(ord(" ") if c == 9 else _MARK[0] if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256))
_GRAMS = "lang string, range long, n long, data binary"


def words_of(text: bytes) -> list[bytes]:
    """A-Z lower-cased words; a full stop between pieces, which no word can be."""
    return text.lower().translate(_CUT).replace(_MARK, b" . ").split()


class Ranges:
    """The range of an n-gram: `first` and `number` of the ranges of each two-byte prefix."""

    def __init__(self, plan: bytes):
        self.first, self.number = np.frombuffer(plan, np.int64).reshape(2, -1)

    @staticmethod
    def plan(weights: dict[int, int], size: int) -> bytes:
        """Prefixes in order share a range while it has at most `size`; a heavier one has ranges of its own."""
        first, number, at, room = np.zeros(65_536, np.int64), np.ones(65_536, np.int64), 0, size
        for prefix in range(65_536):
            n = weights.get(prefix, 0)
            if n > room and room < size:
                at, room = at + 1, size
            first[prefix] = at
            if n > size:
                number[prefix] = -(-n // size)
                at, room = at + number[prefix], size
            else:
                room -= n
        return np.stack([first, number]).tobytes()

    def of(self, words: list[bytes], rows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        prefix = np.array([int.from_bytes(w[:2].ljust(2, b"\0")) for w in words] or [0], np.int64)[rows[:, 0]]
        return self.first[prefix] + (hashes % self.number[prefix].astype(np.uint64)).astype(np.int64)


def gram_hashes(lang: bytes, hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of words (numbers of `hashes`) in a language."""
    out = np.full(len(rows), hash64([lang])[0], np.uint64)
    for k in range(rows.shape[1]):
        out = out * _STEP + hashes[rows[:, k]]
    return mix64(out)


def _distinct(ids: np.ndarray, starts: np.ndarray, order: int, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams at `starts` as rows of word numbers, sorted, and how often each occurs."""
    key = ids[starts].astype(np.int64)
    for k in range(1, order):
        if key.size and int(key.max()) >= 2**62 // max(n_words, 1):
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)  # keeps the order
        key = key * n_words + ids[starts + k]
    _, at, counts = np.unique(key, return_index=True, return_counts=True)
    return ids[starts[at][:, None] + np.arange(order)].astype(np.int64), counts.astype(np.int64)


class Shard:
    """The words of one language in a task, up to a number: appends texts, then gives the transducers of one order."""

    def __init__(self, lang: bytes):
        self.lang, self.index, self.parts, self.size = lang, Index(), [], 0
        self.index[_MARK]  # number 0

    def add(self, text: bytes, order: int) -> None:
        ids = numbered(words_of(text), self.index).astype(np.int32)
        self.parts += [ids, np.zeros(1, np.int32)]
        self.size += len(ids) + 1

    def frequent(self, ids: np.ndarray, order: int, hashes: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
        """The places where an n-gram of that order starts whose two shorter ones may be frequent."""
        n = len(ids) - order + 2
        whole = np.ones(max(n, 0), bool)
        for k in range(order - 1):
            whole &= ids[k : k + n] > 0
        at = np.flatnonzero(whole)
        out = np.full(max(n, 0), hash64([self.lang])[0], np.uint64)[at]
        for k in range(order - 1):
            out = out * _STEP + hashes[ids[at + k]]
        out = mix64(out) >> np.uint64(64 - BITS)
        whole[at] = (bitmap[out >> np.uint64(3)] >> (out & np.uint64(7)).astype(np.uint8)) & 1
        return np.flatnonzero(whole[:-1] & whole[1:])

    def rows(self, order: int, ranges: Ranges, bitmap: np.ndarray) -> Iterator[tuple[str, int, int, bytes]]:
        ids = np.concatenate(self.parts)
        names = list(self.index)
        starts = self.frequent(ids, order, hash64(names), bitmap)
        if not len(starts):
            return
        used = np.zeros(len(names), bool)
        for k in range(order):
            used[ids[starts + k]] = True
        words = sorted(names[i] for i in np.flatnonzero(used))
        rank = np.zeros(len(names), np.int64)
        rank[[self.index[w] for w in words]] = np.arange(len(words))
        grams, counts = _distinct(rank[ids], starts, order, len(words))
        where = ranges.of(words, grams, gram_hashes(self.lang, hash64(words), grams))
        for k, t in split(words, grams, counts, where):
            yield self.lang.decode(), k, order, t.to_bytes()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    lang, k, n, data = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(k, pa.int64()), pa.array(n, pa.int64()), pa.array(data, pa.binary())], names=["lang", "range", "n", "data"])


def _word_counts(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n) of (lang, text), some SHARD words at a time."""
    counts: dict[tuple[bytes, bytes], int] = {}
    size = 0

    def put() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in counts], pa.binary()).cast(pa.string()), pa.array([k[1] for k in counts], pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["lang", "word", "n"])

    from collections import Counter

    for batch in rows:
        for lang, text in zip(utf8(batch, 0), utf8(batch, 1), strict=True):
            own = Counter(words_of(text))
            own.pop(_MARK, None)
            for w, n in own.items():
                counts[lang, w] = counts.get((lang, w), 0) + n
            size += own.total()
            if size >= SHARD:
                yield put()
                counts.clear()
                size = 0
    if counts:
        yield put()


_held: dict[str, tuple[Ranges, np.ndarray]] = {}


def _kept(name: str, plan, bitmap) -> tuple[Ranges, np.ndarray]:
    """What a worker has built of the broadcast variables last."""
    if name not in _held:
        _held.clear()
        _held[name] = Ranges(plan.value), np.frombuffer(bitmap.value, np.uint8) if bitmap else np.empty(0, np.uint8)
    return _held[name]


def _shards(order: int, name: str, plan, bitmap) -> Callable:
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges, bits = _kept(name, plan, bitmap)
        shards: dict[bytes, Shard] = {}

        def put() -> Iterator[pa.RecordBatch]:
            for s in shards.values():
                if found := list(s.rows(order, ranges, bits)):
                    yield _batch(found)
            shards.clear()

        for batch in rows:
            for lang, text in zip(utf8(batch, 0), utf8(batch, 1), strict=True):
                shard = shards.get(lang) or shards.setdefault(lang, Shard(lang))
                shard.add(text, order)
                if sum(s.size for s in shards.values()) >= SHARD:
                    yield from put()
        yield from put()

    return run


def _words(name: str, plan) -> Callable:
    """Transducers of order 1 from (lang, word, n)."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges, _ = _kept(name, plan, None)
        for batch in rows:
            langs, words, n = np.array(utf8(batch, 0), object), utf8(batch, 1), np.array(batch.column(2), np.int64)
            found = []
            for lang in set(langs):
                at = sorted(np.flatnonzero(langs == lang), key=lambda i: words[i])
                own, grams = [words[i] for i in at], np.arange(len(at))[:, None]
                found += [(lang.decode(), k, 1, t.to_bytes()) for k, t in split(own, grams, n[at], ranges.of(own, grams, gram_hashes(lang, hash64(own), grams)))]
            if found:
                yield _batch(found)

    return run


def _united(least: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        """The frequent n-grams of the rows of one language, range and order."""
        t = union([Transducer.from_bytes(d.as_py()) for d in table.column("data")]).at_least(least)
        if not len(t.words):
            return table.slice(0, 0)
        return pa.table({c: table.column(c).slice(0, 1) for c in ("lang", "range", "n")} | {"data": pa.array([t.to_bytes()], pa.binary())})

    return run


def _positions(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bits that the n-grams of (lang, range, n, data) set."""
    for batch in rows:
        for lang, data in zip(utf8(batch, 0), batch.column(3), strict=True):
            t = Transducer.from_bytes(data.as_py())
            at = gram_hashes(lang, hash64(t.words), t.paths()[0]) >> np.uint64(64 - BITS)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(at).astype(np.int64))], names=["at"])


def _bitmap(grams: DataFrame) -> bytes:
    """A bit for each frequent n-gram, by its hash; of a fixed size, however many there are."""
    page = 32_768
    pages = grams.mapInArrow(_positions, "at long").groupBy(F.expr(f"`at` div {page}").alias("page")).agg(F.bitmap_construct_agg(F.col("at") % page).alias("bits")).collect()
    out = np.zeros((2**BITS // page, page // 8), np.uint8)
    for r in pages:
        out[r["page"]] = np.frombuffer(r["bits"], np.uint8)
    return out.tobytes()


def _parts(t: Transducer) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """The distinct parts of the n-grams by their order: (rows of labels, for each n-gram and part its number, the number of the first word)."""
    rows, _ = t.paths()
    k = rows.shape[1]
    out = []
    for order in range(1, k):
        both = np.concatenate([rows[:, :order], rows[:, k - order :]])
        distinct, number = np.unique(both, axis=0, return_inverse=True)
        out.append((distinct, number.reshape(2, -1), order))
    return out


def _asked(name: str, plan) -> Callable:
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Acceptors of the parts of the candidates, for each order and range: (lang, range, n, data, source, of)."""
        ranges, _ = _kept(name, plan, None)
        for batch in rows:
            for lang, source, n, data in zip(utf8(batch, 0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
                if n < 2:
                    continue
                t = Transducer.from_bytes(data.as_py())
                hashes, out = hash64(t.words), []
                for parts, _, order in _parts(t):
                    where = ranges.of(t.words, parts, gram_hashes(lang, hashes, parts))
                    out += [(lang.decode(), k, order, a.to_bytes()) for k, a in split(t.words, parts, np.ones(len(parts), np.int64), where)]
                made = _batch(out)
                yield pa.RecordBatch.from_arrays([*made.columns, pa.array([source] * len(out), pa.int64()), pa.array([n] * len(out), pa.int64())], names=[*made.schema.names, "source", "of"])

    return run


def _answered(table: pa.Table) -> pa.Table:
    """Of the rows of one language, range and order: the transducer, and for each acceptor the weights of its n-grams."""
    data, source = table.column("data").to_pylist(), table.column("source").to_pylist()
    own = next((Transducer.from_bytes(d) for d, s in zip(data, source, strict=True) if s is None), None)
    asked = [i for i, s in enumerate(source) if s is not None]
    if asked and own is None:
        raise ValueError("the parts of frequent phrases are frequent")
    table = table.take(pa.array(asked, pa.int64()))
    return table.set_column(table.schema.get_field_index("data"), "data", pa.array([own.weights_of(Transducer.from_bytes(data[i])).tobytes() for i in asked], pa.binary()))


def _scored(name: str, plan) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        """Of the candidates of one language, range and order and the weights of their parts: each phrase with its best-known cut."""
        ranges, _ = _kept(name, plan, None)
        lang = (table.column("lang")[0].as_py() or "").encode()
        data, kinds = table.column("data").to_pylist(), list(zip(table.column("part").to_pylist(), table.column("at").to_pylist(), strict=True))
        t = next(Transducer.from_bytes(d) for d, k in zip(data, kinds, strict=True) if k[0] is None)
        told = {k: np.frombuffer(d, np.int64) for d, k in zip(data, kinds, strict=True) if k[0] is not None}
        rows, count = t.paths()
        k, hashes = rows.shape[1], hash64(t.words)
        left, right = np.zeros((k, len(rows)), np.int64), np.zeros((k, len(rows)), np.int64)
        for parts, number, order in _parts(t):
            where, weight = ranges.of(t.words, parts, gram_hashes(lang, hashes, parts)), np.zeros(len(parts), np.int64)
            for at in np.unique(where):
                weight[where == at] = told[order, int(at)]
            left[order], right[k - order] = weight[number[0]], weight[number[1]]
        out = []
        for i, (row, a) in enumerate(zip(rows.tolist(), count.tolist(), strict=True)):
            score, cut = min((SCALE * a // (int(left[c, i]) + int(right[c, i])), c) for c in range(1, k))
            out.append((b" ".join([t.words[w] for w in row]).decode(), k, a, int(left[cut, i]), int(right[cut, i]), score))
        names = ["phrase", "words", "a", "l", "r", "score"]
        return pa.table({"lang": pa.array([lang.decode()] * len(out))} | {n: pa.array(c, pa.string() if n == "phrase" else pa.int64()) for n, c in zip(names, zip(*out, strict=True), strict=True)})

    return run


def collocations(docs: DataFrame, *, least: int = LEAST, top: int | None = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the `top` phrases of each language (all, if None) of docs (lang, text)."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    words = texts.mapInArrow(_word_counts, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = written(words, "words")
    langs = written(words.groupBy("lang").agg(F.sum("n").alias("n")), "langs")
    # at most 65,536 prefixes
    prefix = F.conv(F.hex(F.rpad(F.substring("word", 1, 2), 2, b"\0")), 16, 10).cast("int")
    weights = {r["prefix"]: r["n"] for r in words.groupBy(prefix.alias("prefix")).agg(F.sum("n").alias("n")).collect()}
    name, plan = uuid.uuid4().hex, spark.sparkContext.broadcast(Ranges.plan(weights, RANGE))
    grams = [written(words.where(F.col("n") >= least).mapInArrow(_words(f"{name}-0", plan), _GRAMS).groupBy("lang", "range", "n").applyInArrow(_united(least), _GRAMS), "grams")]
    for order in range(2, MOST + 1):
        bitmap = spark.sparkContext.broadcast(_bitmap(grams[-1]))
        found = texts.mapInArrow(_shards(order, f"{name}-{order}", plan, bitmap), _GRAMS)
        grams.append(written(found.groupBy("lang", "range", "n").applyInArrow(_united(least), _GRAMS), "grams"))
    every = grams[0]
    for g in grams[1:]:
        every = every.unionByName(g)

    none = F.lit(None).cast("long")
    asked = every.mapInArrow(_asked(f"{name}-0", plan), _GRAMS + ", source long, of long")
    both = written(asked.unionByName(every.where(f"n < {MOST}").withColumns({"source": none, "of": none})), "parts")
    told = written(both.groupBy("lang", "range", "n").applyInArrow(_answered, _GRAMS + ", source long, of long"), "weights")
    told = told.select("lang", F.col("source").alias("range"), F.col("of").alias("n"), "data", F.col("n").alias("part"), F.col("range").alias("at"))
    own = every.where("n > 1").withColumns({"part": none, "at": none})
    found = written(own.unionByName(told).groupBy("lang", "range", "n").applyInArrow(_scored(f"{name}-0", plan), "lang string, phrase string, words long, a long, l long, r long, score long"), "scored")

    # phrases inside longer ones: every run of words of a phrase but the whole
    w = F.split("phrase", " ")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda k: F.transform(F.sequence(F.lit(1), F.col("words") - k + 1), lambda i: F.array_join(F.slice(w, i.cast("int"), k.cast("int")), " "))))
    longest = found.where("words > 2").select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    out = found.join(longest, ["lang", "phrase"], "left").where(f"most is null or 100 * cast(most as decimal(38,0)) < {HELD_PERCENT} * cast(a as decimal(38,0))")
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    if top is not None:  # first within a share of a language, then of the language
        share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*best)
        out = out.withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= top)
    out = out.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
    out = out if top is None else out.where(F.col("rank") <= top)
    few = F.broadcast(langs) if langs.count() <= BROADCAST_LANGS else langs
    return out.join(few, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


_SPLIT = "list_filter(string_split_regex({x}, '[ \\t]+'), lambda w: w <> '')"
ORACLE = f"""
WITH docs AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM docs),
p AS (SELECT lang, {_SPLIT.format(x="piece")} AS w FROM pieces),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
f AS (SELECT lang, k, phrase, count(*) AS f FROM (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i+k-1], ' '))) AS phrase FROM p, (SELECT unnest([1, 2, 3, 4]) AS k)) GROUP BY ALL HAVING count(*) >= {LEAST}),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (SELECT lang, k, phrase, a, w, unnest(range(1, k)) AS cut FROM c),
scores AS (
  SELECT cuts.lang, cuts.phrase, a, l.f AS l, r.f AS r, cut, CAST(CAST({SCALE} AS HUGEINT) * a // (l.f + r.f) AS BIGINT) AS score
  FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = array_to_string(w[1:cut], ' ') JOIN f r ON r.lang = cuts.lang AND r.phrase = array_to_string(w[cut+1:cuts.k], ' ')),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS rk FROM scores) WHERE rk = 1),
inner_ AS (SELECT lang, array_to_string(w[i:i+m-1], ' ') AS phrase, max(a) AS most FROM (SELECT lang, w, a, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT lang, w, a, k, unnest(range(2, k)) AS m FROM c)) GROUP BY 1, 2),
kept AS (SELECT b.* FROM best b LEFT JOIN inner_ i ON b.lang = i.lang AND b.phrase = i.phrase WHERE i.most IS NULL OR 100 * CAST(i.most AS HUGEINT) < {HELD_PERCENT} * CAST(b.a AS HUGEINT)),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score FROM kept)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total ON ranked.lang = total.lang WHERE rank <= {TOP}"""
