"""Language-model scores by a hierarchical Pitman-Yor bigram model.

Each context (the preceding word) is a restaurant whose customers are the words that follow it; all context
restaurants share one parent, the unigram restaurant, whose base is uniform over the vocabulary and one unknown
word. Every table in a context restaurant sends one customer to the parent. Seatings are sampled by blocked
Gibbs: the tables of one dish in one restaurant are drawn from their conditional given the parent's probability
and the other dishes' tables, with the sizes of the tables summed out (generalised Stirling numbers) up to
EXACT customers; what a dish has beyond that is seated in growing groups, each with its expected share of new
tables. Restaurants that share a parent are sampled side by side with the parent's last state, and the parent
before each of the two rounds, each of its words once and from its tables of the round before. Predictive probabilities are averaged over the samples of the last round.

How it runs: tasks turn blocks of documents into the block's distinct (context, word) pairs, with their training
counts and the documents that hold them, dealt out by context; so a pair costs the shuffle one entry per block
and not one per occurrence. Each part samples its contexts, exchanging with the parent only sums by word; the
parts of the parent first tell each other their totals. A part of contexts
then returns to each block one partial sum per document. Nothing is collected or broadcast.

Null and empty texts consist of the end token. Null ids count as the empty text in the split. Repeated rows are
learnt from and scored as often as they are there. An empty table gives an empty result. Without any document
to learn from all words are unknown and the score is that of the uniform base. Other columns are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from ._base import Index, fold, hash64, mix64, numbered, shuffle_parts, utf8

#: Tokens in a block of documents, and the most documents in it (16 bits number them).
BLOCK_TOKENS, BLOCK_DOCS = 3_000_000, 60_000
STRENGTH = 1.0
BURN_IN, SAMPLES = 1, 3
#: Up to so many customers a dish's tables are drawn from their exact conditional.
EXACT = 64
HELD_OUT_FOLD = 1

_START, _END = b" start", b" end"  # no word holds a space


def _packed(x) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(x, protocol=5))


def _unpacked(x: bytes):
    import zstandard

    return pickle.loads(zstandard.ZstdDecompressor().decompress(x))


def _slim(x: np.ndarray) -> np.ndarray:
    """The same non-negative integers in the smallest type that holds them."""
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if top < 2**8 else np.uint16 if top < 2**16 else np.uint32 if top < 2**32 else np.uint64)


def _runs(sorted_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal values."""
    if not len(sorted_):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    starts = np.flatnonzero(np.concatenate(([True], sorted_[1:] != sorted_[:-1])))
    return starts, np.diff(np.append(starts, len(sorted_)))


def _block(docs: list[tuple], ids: list[np.ndarray], index: Index, parts: int, name: int) -> Iterator[tuple[int, int, bytes]]:
    """(part, block, content) for one block; docs: (doc_id, held_out, tokens)."""
    lengths = np.array([len(x) for x in ids], np.int64)
    word = np.concatenate(ids)
    context = np.empty_like(word)
    context[1:] = word[:-1]
    context[np.cumsum(lengths) - lengths] = index[_START]
    size = np.int64(len(index))
    doc = np.repeat(np.arange(len(ids), dtype=np.int64), lengths)
    held = np.array([x[1] for x in docs], bool)
    hashes = hash64(index)
    part = (mix64(hashes + np.uint64(1)) % np.uint64(parts)).astype(np.int64)
    pair, names = context * size + word, None
    if len(index) ** 2 >= 2**47:  # a pair and a document don't fit in 63 bits: number the pairs, in their order
        names, pair = np.unique(pair, return_inverse=True)
    packed = np.sort((pair << 16) | doc)
    at, times = _runs(packed)
    packed = packed[at]
    pair_doc, pair_key = packed & 0xFFFF, packed >> 16
    key_at, n_pairs = _runs(pair_key)
    key = pair_key[key_at] if names is None else names[pair_key[key_at]]
    train = np.add.reduceat(np.where(held[pair_doc], 0, times), key_at) if len(key_at) else np.empty(0, np.int64)
    of = part[key // size]
    order = np.argsort(of, kind="stable")
    bounds = np.searchsorted(of[order], np.arange(parts + 1))
    ends = np.cumsum(n_pairs)
    home = name % parts
    for p in range(parts):
        mine = order[bounds[p] : bounds[p + 1]]
        if not len(mine) and p != home:
            continue
        u, w = key[mine] // size, key[mine] % size
        u_at, u_n = _runs(u)
        words, w_of = np.unique(w, return_inverse=True)
        n = n_pairs[mine]
        inside = np.repeat(ends[mine] - n - (np.cumsum(n) - n), n) + np.arange(n.sum())
        yield p, name, _packed((hashes[u[u_at]], _slim(u_n), hashes[words], _slim(w_of), _slim(train[mine]), _slim(n), _slim(pair_doc[inside]), _slim(times[inside]), len(docs), docs if p == home else None))


def _blocks(parts: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        name = TaskContext.get().partitionId() << 24
        docs, ids, index, n = [], [], Index({_START: 0, _END: 1}), 0

        def flush():
            for row in _block(docs, ids, index, parts, name):
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["part", "block", "content"])

        for batch in rows:
            for doc_id, held, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch, 2), strict=True):
                words = text.lower().split()
                words.append(_END)
                docs.append((doc_id, held, len(words)))
                ids.append(numbered(words, index))
                n += len(words)
                if n >= BLOCK_TOKENS or len(docs) >= BLOCK_DOCS:
                    yield from flush()
                    docs, ids, index, n, name = [], [], Index({_START: 0, _END: 1}), 0, name + 1
        if docs:
            yield from flush()

    return run


class _Part:
    """The pairs of one part, merged over its blocks, in a fixed order."""

    def __init__(self, contents: list[bytes], keep: bool):
        self.blocks, u_all, w_all, c_all = [], [], [], []
        for content in contents:
            uh, un, wh, wi, train, n, pd_, pc, n_docs, docs = _unpacked(content)
            u, w = np.repeat(uh, un), wh[wi]
            u_all.append(u), w_all.append(w), c_all.append(train.astype(np.int64))
            self.blocks.append((n, pd_, pc, n_docs, docs) if keep else None)
        u, w, c = np.concatenate(u_all), np.concatenate(w_all), np.concatenate(c_all)
        sizes = [len(x) for x in u_all]
        del u_all, w_all, c_all
        key, first, inverse = np.unique(mix64(u) + mix64(w ^ np.uint64(0x9E3779B97F4A7C15)), return_index=True, return_inverse=True)
        self.count = np.bincount(inverse, weights=c, minlength=len(key)).astype(np.int64)
        self.inverse = np.split(inverse.astype(np.int32), np.cumsum(sizes)[:-1]) if keep else None
        self.contexts, self.context = np.unique(u[first], return_inverse=True)
        self.words, self.word = np.unique(w[first], return_inverse=True)
        self.customers = np.bincount(self.context, weights=self.count, minlength=len(self.contexts))


def _stirling(discount: float) -> np.ndarray:
    """Logs of the generalised Stirling numbers S(c, t) for c, t up to EXACT."""
    out = np.full((EXACT + 1, EXACT + 1), -np.inf)
    out[1, 1] = 0.0
    t = np.arange(EXACT + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        for c in range(1, EXACT):
            stay = out[c] + np.log(np.maximum(c - discount * t, 1e-300))
            out[c + 1, 1:] = np.logaddexp(out[c, :-1], stay[1:])
    return out


def sample_tables(count: np.ndarray, prior: np.ndarray, others: np.ndarray, discount: float, strength: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish: count customers, prior from the parent, others: tables of the other dishes of its restaurant."""
    tables = np.minimum(count, 1)
    logs = _stirling(discount)
    alpha = strength + discount * others
    seated = np.minimum(count, EXACT)
    order = np.argsort(seated, kind="stable")
    bounds = np.searchsorted(seated[order], np.arange(EXACT + 2))
    for c in range(2, EXACT + 1):
        rows = order[bounds[c] : bounds[c + 1]]
        for at in range(0, len(rows), 2_000_000 // c + 1):
            r = rows[at : at + 2_000_000 // c + 1]
            weight = np.cumsum(np.log(alpha[r, None] + discount * np.arange(c)[None, :]), axis=1) + np.arange(1, c + 1)[None, :] * np.log(prior[r, None])
            weight += logs[c, 1 : c + 1][None, :] + rng.gumbel(size=weight.shape)
            tables[r] = weight.argmax(axis=1) + 1
    rows = np.flatnonzero(count > EXACT)
    n = np.full(len(rows), float(EXACT))
    while len(rows):
        step = np.minimum(np.maximum(1, n // 8), count[rows] - n)
        new = (alpha[rows] + discount * tables[rows]) * prior[rows]
        tables[rows] += rng.binomial(step.astype(np.int64), new / (new + n - discount * tables[rows]))
        n = n + step
        more = n < count[rows]
        rows, n = rows[more], n[more]
    return tables


def _discount(ones: float, twos: float) -> float:
    """The usual estimate from the numbers of dishes with one and with two customers."""
    return float(np.clip(ones / (ones + 2 * twos), 0.1, 0.95)) if ones + twos > 0 else 0.75


def _to_root(part: _Part, tables: np.ndarray, parts: int, p: int, parent: _Parent | None = None) -> pd.DataFrame:
    """What a part tells the parent: for each of its words the tables that serve it, the training count and the parent's last tables, if any."""
    served = np.bincount(part.word, weights=tables, minlength=len(part.words)).astype(np.int64)
    seen = np.bincount(part.word, weights=part.count, minlength=len(part.words)).astype(np.int64)
    to = (mix64(part.words) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    bounds = np.searchsorted(to[order], np.arange(parts + 1))
    ones, twos = int((part.count == 1).sum()), int((part.count == 2).sum())
    rows = [(q, p, _packed((part.words[m], _slim(served[m]), _slim(seen[m]), ones, twos, None if parent is None else _slim(parent.tables[m])))) for q in range(parts) for m in (order[bounds[q] : bounds[q + 1]],)]
    return pd.DataFrame(rows, columns=["part", "sender", "content"])


class _Told:
    """What all parts told one part of the parent."""

    def __init__(self, rows: pd.DataFrame):
        rows = rows.sort_values("sender")
        self.senders = rows["sender"]
        got = [_unpacked(x) for x in rows["content"]]
        words, inverse = np.unique(np.concatenate([g[0] for g in got]), return_inverse=True)
        self.served, self.seen = (np.bincount(inverse, weights=np.concatenate([g[k] for g in got]).astype(float), minlength=len(words)).astype(np.int64) for k in (1, 2))
        self.at = np.split(inverse, np.cumsum([len(g[0]) for g in got])[:-1])
        self.pairs = (sum(g[3] for g in got), sum(g[4] for g in got))
        #: Tables of the parent before it is seated anew; at first each word has one.
        self.before = np.minimum(self.served, 1)
        for at, g in zip(self.at, got, strict=True):
            if g[5] is not None:
                self.before[at] = g[5]


def _totals(parts: int):
    """Sums over one part of the parent, for each of its parts: customers, words, training tokens, words with one and two customers, tables."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        told = _Told(rows)
        sums = _packed(tuple(int(x.sum()) for x in (told.served, told.seen > 0, told.seen, told.served == 1, told.served == 2, told.before)))
        return pd.DataFrame([(q, int(key[0]), sums) for q in range(parts)], columns=["part", "sender", "content"])

    return run


def _root(seed: int, turn: int):
    """The parent's answer to each part: customers, training count and tables of each word, the tables of this part of the parent, and the totals of all."""

    def run(key: tuple, rows: pd.DataFrame, totals: pd.DataFrame) -> pd.DataFrame:
        told = _Told(rows)
        sums = [sum(x) for x in zip(*map(_unpacked, totals["content"]), strict=True)]
        _, types, _, ones, twos, before = sums
        rng = np.random.default_rng([seed, int(key[0]), 2 + turn])
        tables = sample_tables(told.served, np.full(len(told.served), 1 / (types + 1)), before - told.before, _discount(ones, twos), STRENGTH, rng)
        out = [(int(sender), int(key[0]), _packed((_slim(told.served[at]), _slim(told.seen[at]), _slim(tables[at]), int(tables.sum()), sums, told.pairs))) for sender, at in zip(told.senders, told.at, strict=True)]
        return pd.DataFrame(out, columns=["part", "sender", "content"])

    return run


class _Parent:
    """The parent as one part sees it: probabilities, training counts and tables of its own words, and the totals."""

    def __init__(self, part: _Part, answers: pd.DataFrame, parts: int):
        served, self.seen, self.tables = (np.zeros(len(part.words), np.int64) for _ in range(3))
        to = (mix64(part.words) % np.uint64(parts)).astype(np.int64)
        total = 0
        for sender, content in zip(answers["sender"], answers["content"], strict=True):
            mine = to == sender
            served[mine], self.seen[mine], self.tables[mine], n, sums, pairs = _unpacked(content)
            total += n
        customers, self.types, self.tokens, ones, twos, _ = sums
        self.discount = _discount(*pairs)
        d = _discount(ones, twos)
        #: Of a word that was never learnt from; with it the probabilities of all words sum to one.
        self.unknown = (STRENGTH + d * total) / (self.types + 1) / (STRENGTH + customers)
        self.prior = (served - d * self.tables) / (STRENGTH + customers) + self.unknown


def _first(parts: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        part = _Part(list(rows.sort_values("block")["content"]), False)
        return _to_root(part, np.minimum(part.count, 1), parts, int(key[0]))

    return run


def _gibbs(part: _Part, parent: _Parent, rng: np.random.Generator, rounds: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(tables of each pair, tables of each context) after each sweep."""
    tables = np.minimum(part.count, 1)
    for _ in range(rounds):
        total = np.bincount(part.context, weights=tables, minlength=len(part.contexts))
        tables = sample_tables(part.count, parent.prior[part.word], total[part.context] - tables, parent.discount, STRENGTH, rng)
        yield tables, np.bincount(part.context, weights=tables, minlength=len(part.contexts))


def _second(parts: int, seed: int):
    def run(key: tuple, rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        p, part = int(key[0]), _Part(list(rows.sort_values("block")["content"]), False)
        rng = np.random.default_rng([seed, p, 1])
        parent = _Parent(part, answers, parts)
        for tables, _ in _gibbs(part, parent, rng, BURN_IN + 1):
            pass
        return _to_root(part, tables, parts, p, parent)

    return run


def _third(parts: int, seed: int):
    """Of each block and part: for each document the log10 score, the base score and the unknown tokens of its pairs."""

    def run(key: tuple, rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        p, rows = int(key[0]), rows.sort_values("block")
        part = _Part(list(rows["content"]), True)
        rng = np.random.default_rng([seed, p, 2])
        parent = _Parent(part, answers, parts)
        prior, known = parent.prior[part.word], part.customers[part.context]
        mean = np.zeros(len(prior))
        for k, (tables, total) in enumerate(_gibbs(part, parent, rng, BURN_IN + SAMPLES)):
            if k >= BURN_IN:
                mean += (np.maximum(part.count - parent.discount * tables, 0) + (STRENGTH + parent.discount * total[part.context]) * prior) / (STRENGTH + known)
        score = np.log10(mean / SAMPLES)
        seen = parent.seen[part.word]
        base = np.log10(seen + 0.5) - np.log10(parent.tokens + 0.5 * (parent.types + 1))
        out = []
        for block, inverse, (n, docs_of, times, n_docs, docs) in zip(rows["block"], part.inverse, part.blocks, strict=True):
            pair = np.repeat(inverse, n)
            sums = [np.bincount(docs_of, weights=times * x[pair], minlength=n_docs) for x in (score, base, (seen == 0).astype(float))]
            out.append((int(block), p, _packed((sums[0], sums[1], _slim(sums[2].astype(np.int64)), int(parent.tokens), docs))))
        return pd.DataFrame(out, columns=["block", "part", "content"])

    return run


def _gather(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    score = base = unknown = docs = None
    for content in rows.sort_values("part")["content"]:
        s, b, n, tokens, own = _unpacked(content)
        score, base, unknown = (s, b, n.astype(np.int64)) if score is None else (score + s, base + b, unknown + n)
        docs = own or docs
    n_tokens = np.array([d[2] for d in docs], np.int64)
    return pd.DataFrame({"doc_id": pd.array([d[0] for d in docs], "Int64"), "held_out": [d[1] for d in docs], "n_tokens": n_tokens, "n_known": n_tokens - unknown, "train_tokens": tokens, "base_score": base, "score": score})


def score_documents(docs: DataFrame, *, seed: int = 11, parts: int | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probability of the whole text) for each row of docs (doc_id, text).

    Documents whose crc32(doc_id as text) mod 5 is 1 are held out; all others are learnt from. The perplexity of
    any set of documents is 10 ** (-sum(score) / sum(n_tokens)).
    """
    parts = parts or shuffle_parts(docs.sparkSession)
    blocks = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold(F.col("doc_id")) == HELD_OUT_FOLD).alias("held"), "text").mapInArrow(_blocks(parts), "part long, block long, content binary").repartition(parts, "part")
    message = "part long, sender long, content binary"

    def ask(told: DataFrame, turn: int) -> GroupedData:
        told = told.repartition(parts, "part")
        totals = told.groupBy("part").applyInPandas(_totals(parts), message).repartition(parts, "part")
        return told.groupBy("part").cogroup(totals.groupBy("part")).applyInPandas(_root(seed, turn), message).repartition(parts, "part").groupBy("part")

    first = ask(blocks.groupBy("part").applyInPandas(_first(parts), message), 1)
    second = ask(blocks.groupBy("part").cogroup(first).applyInPandas(_second(parts, seed), message), 2)
    sums = blocks.groupBy("part").cogroup(second).applyInPandas(_third(parts, seed), "block long, part long, content binary")
    return sums.groupBy("block").applyInPandas(_gather, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
