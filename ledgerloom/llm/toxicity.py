"""Toxicity by a weighted lexicon.

Texts are folded (lower-cased, homoglyphs, accents and digit substitutions to Latin letters, punctuation to spaces)
and matched by Aho-Corasick against entries anchored at the start of a word. Entries are words and word stems
whose documents are labelled toxic far more often than others; their weights are smoothed log odds. Exceptions are
words that start like an entry, and phrases of two or three words around a hit, that clean documents have without being
more common in toxic ones; a hit inside an exception does not count. The weight of the hits, also per hundred words,
goes through a two-input logistic that is fit on the same labelled rows.

The fits read at most SAMPLE labelled ids; of these all rows are counted, and the logistic takes the least weighty row of
each. An entry's share of the toxic documents bounds how many entries there are. Null and empty texts have no hits and
get the score of a text without hits. Without labels of both kinds the score is the share of toxic labels. Repeated rows
count as often as they are there; of several labels of an id the largest counts; null ids are not learnt from. Ties
between entries go to the shorter, then the first. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import functools
import operator
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._base import fold, written

#: The most labelled rows that the lexicon and the logistic are learnt from, chosen by a hash of the id.
SAMPLE = 20_000
STEMS = range(4, 13)
#: An entry is in at least so many labelled toxic documents, and in at least this share of them.
MIN_DOCS, MIN_TOXIC_SHARE, MIN_WEIGHT = 4, 0.01, 2.5
#: An exception is in at least so many clean documents, and its log odds are below this.
MIN_CLEAN, MAX_ODDS = 2, 1.0

# Letters of other scripts that look like Latin letters, and signs written for letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x",
    "А": "a", "В": "b", "С": "c", "Е": "e", "Н": "h", "І": "i", "Ј": "j", "К": "k", "М": "m", "О": "o", "Р": "p", "Ѕ": "s", "Т": "t", "У": "y", "Х": "x",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s",
}


def _look_alikes() -> dict[int, str]:
    """Letters with accents, of full width and of mathematical alphabets as what they are made of."""
    out = {c: "" for c in (0xAD, *range(0x200B, 0x200E), *range(0x300, 0x370))}
    for c in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF10, 0xFF5B), *range(0x1D400, 0x1D800)):
        base = "".join(x for x in unicodedata.normalize("NFKD", chr(c)) if not unicodedata.combining(x)).lower()
        if base.isascii() and base.isalnum():
            out[c] = "".join(HOMOGLYPHS.get(x, x) for x in base)
    return out


_FOLD = {ord(k): v for k, v in HOMOGLYPHS.items()} | {c: " " for c in range(128) if not chr(c).isalnum() and chr(c) not in "@$"} | _look_alikes()


_WORD = re.compile(r"[^ ]+")


def folded(text: str | None) -> str:
    """The folded text with a space before each word and at the end."""
    return f" {(text or '').lower().translate(_FOLD)} "


def _terms(text: str) -> set[str]:
    """The anchored words and stems of a folded text: ' word ' and ' stem'."""
    out = set()
    for w in set(text.split()):
        out.add(f" {w} ")
        out.update(f" {w[:k]}" for k in STEMS if k <= len(w))
    return out


def _phrases(auto):
    """The phrases of two and three words around the hits of a folded text."""

    def of(text: str) -> set[str]:
        starts = {end - size + 2 for end, (size, _) in auto.iter(text)} if len(auto) else ()
        if not starts:
            return set()
        places = [(m.start(), m[0]) for m in _WORD.finditer(text)]
        words, out = [w for _, w in places], set()
        for k, (at, _) in enumerate(places):
            if at in starts:
                out.update(f" {' '.join(words[i:j])} " for i, j in ((k - 1, k + 1), (k, k + 2), (k - 1, k + 2)) if i >= 0 and j <= len(words))
        return out

    return of


def _count(terms_of):
    """Documents by term and label, summed within the task."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, toxic, clean = terms_of(), Counter(), Counter()

        def flush():
            terms = list(toxic | clean)
            toxic_, clean_ = [toxic[t] for t in terms], [clean[t] for t in terms]
            toxic.clear(), clean.clear()
            for at in range(0, len(terms), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(terms[at : at + 50_000], pa.string()), pa.array(toxic_[at : at + 50_000], pa.int64()), pa.array(clean_[at : at + 50_000], pa.int64())], names=["term", "toxic", "clean"])

        for batch in rows:
            for text, y in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                (toxic if y else clean).update(find(folded(text.as_py())))
                if len(clean) + len(toxic) > 400_000:
                    yield from flush()
        yield from flush()

    return run


@dataclass(frozen=True)
class Lexicon:
    """weights: anchored entries; exceptions: anchored words and phrases in which nothing is a hit; coef: of the logistic."""

    weights: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...]
    coef: tuple[float, float, float] = (0.0, 1.0, 1.0)

    def automaton(self):
        import ahocorasick

        auto = ahocorasick.Automaton()
        for term, w in self.weights:
            auto.add_word(term, (len(term), w))
        for term in self.exceptions:
            auto.add_word(term, (len(term), -1.0))
        if len(auto):
            auto.make_automaton()
        return auto


def _inputs(text: str, auto) -> tuple[int, float, float]:
    """Hits, log of the weight in all, and the weight per hundred words (of 20 words at least)."""
    best: dict[int, float] = {}
    excepted: list[tuple[int, int]] = []
    if len(auto):
        for end, (size, w) in auto.iter(text):
            at = end - size
            if w < 0:
                excepted.append((at, end))
            else:
                best[at] = max(best.get(at, 0.0), w)
    for at, end in excepted:
        # an exception ends with the space before the next word, where that word's hit begins
        for k in [k for k in range(at, end - 1) if k in best]:
            del best[k]
    hits = list(best.values())
    if not hits:
        return 0, 0.0, 0.0
    total = sum(hits)
    return len(hits), float(np.log1p(total)), float(np.log1p(100 * total / max(20, text.count(" "))))


def _measured(lexicon: Lexicon, extra: str):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = lexicon.automaton()
        for batch in rows:
            got = [_inputs(folded(t.as_py()), auto) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[0] for x in got], pa.int64()), pa.array([x[1] for x in got], pa.float64()), pa.array([x[2] for x in got], pa.float64())], names=[extra, "n_hits", "weight", "density"])

    return run


def _choose(terms: list[tuple[str, int, int]], n_toxic: int, n_clean: int) -> tuple[tuple[str, float], ...]:
    """Entries by falling evidence (toxic documents times weight), without those that a chosen stem already covers."""
    odds = lambda a, b: float(np.log((a + 0.5) / (n_toxic + 1)) - np.log((b + 0.5) / (n_clean + 1)))
    entries: dict[str, float] = {}
    for term, a, b in sorted(terms, key=lambda x: (-x[1] * odds(x[1], x[2]), len(x[0]), x[0])):
        w = odds(a, b)
        # the odds must also hold if a few more clean documents had the term
        if a < max(MIN_DOCS, MIN_TOXIC_SHARE * n_toxic) or w < MIN_WEIGHT or odds(a, b + 1.5) < 1.5 or any(term[:k] in entries for k in range(2, len(term))):
            continue
        entries[term] = w
    return tuple(sorted(entries.items()))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Two inputs and an intercept, by Newton steps with a small ridge."""
    x = np.hstack([np.ones((len(y), 1)), x])
    w = np.zeros(3)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        ridge = np.diag([1e-6, 0.5, 0.5])
        w = w - np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge + 1e-9 * np.eye(3), x.T @ (p - y) + ridge @ w)
    return float(w[0]), float(w[1]), float(w[2])


def learn(docs: DataFrame, labels: DataFrame, *, target: str = "toxic", sample: int = SAMPLE) -> Lexicon:
    """Learn from at most `sample` labelled rows of the learning folds (crc32 of the id mod 5 is not 0)."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull() & (fold(F.col("doc_id")) != 0)).groupBy("doc_id").agg((F.max(target) > 0).cast("int").alias("y"))
    known = written(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "labelled")
    # at most `sample` rows of 12 bytes
    rows = written(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("doc_id", "text", "y"), "labelled")
    n = rows.agg(F.coalesce(F.sum("y"), F.lit(0)).alias("t"), F.count("*").alias("n")).first()
    n_toxic, n_clean = int(n["t"]), int(n["n"] - n["t"])
    if not n_toxic or not n_clean:
        share = (n_toxic + 0.5) / (n_toxic + n_clean + 1)
        return Lexicon((), (), (float(np.log(share / (1 - share))), 0.0, 0.0))
    counted = lambda terms_of: rows.mapInArrow(_count(terms_of), "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    terms = written(counted(lambda: _terms), "terms")
    ratio = (F.col("toxic") + 0.5) / (F.col("clean") + 0.5) * ((n_clean + 1) / (n_toxic + 1))
    # so common a term takes its share of the toxic documents, so there are few
    top = terms.where((F.col("toxic") >= max(MIN_DOCS, MIN_TOXIC_SHARE * n_toxic)) & (ratio >= float(np.exp(MIN_WEIGHT))))
    entries = _choose([(r["term"], r["toxic"], r["clean"]) for r in top.collect()], n_toxic, n_clean)
    exceptions: set[str] = set()
    if entries:
        harmless = (F.col("clean") >= MIN_CLEAN) & (ratio < float(np.exp(MAX_ODDS)))
        stems = [t for t, _ in entries if not t.endswith(" ")]
        if stems:
            starts = functools.reduce(operator.or_, [F.substring("term", 1, n).isin(*[t for t in stems if len(t) == n]) for n in sorted({len(t) for t in stems})])
            exceptions |= {r["term"] for r in terms.where(F.col("term").endswith(" ") & harmless & starts).select("term").collect()}
        hits = Lexicon(entries, ())
        exceptions |= {r["term"] for r in counted(lambda: _phrases(hits.automaton())).where(harmless).select("term").collect()}
    lexicon = Lexicon(entries, tuple(sorted(exceptions - {t for t, _ in entries})))
    got = rows.select("doc_id", "text").mapInArrow(_measured(lexicon, "doc_id"), "doc_id long, n_hits long, weight double, density double").join(F.broadcast(known), "doc_id")
    got = got.groupBy("doc_id", "y").agg(F.min(F.struct("weight", "density")).alias("x")).select("doc_id", "y", "x.*").toPandas().sort_values("doc_id")
    return Lexicon(entries, lexicon.exceptions, _logistic(got[["weight", "density"]].to_numpy(float), got["y"].to_numpy(float)))


def toxicity_scores(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_hits) for each row of docs (doc_id, text)."""
    lexicon = learn(docs, labels, sample=sample)
    got = docs.select("doc_id", "text").mapInArrow(_measured(lexicon, "doc_id"), "doc_id long, n_hits long, weight double, density double")
    a, b, c = lexicon.coef
    score = 1 / (1 + F.exp(-(F.lit(a) + b * F.col("weight") + c * F.col("density"))))
    return got.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), score.alias("score"), "n_hits").withColumn("predicted", (F.col("score") >= 0.5).cast("int")).select("doc_id", "held_out", "score", "predicted", "n_hits")
