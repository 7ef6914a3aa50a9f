"""Quality classifier: a sparse ensemble of rules over text statistics.

Small boosted trees are grown on a bounded sample of labelled rows; every path from a root to a node is a
conjunctive rule; a lasso logistic regression keeps few of them; and what it keeps is compiled into one Spark
column expression over the statistics, which scores every document inside the JVM.

The statistics cover whole texts. Null and empty texts have statistics of 0. Labels of ids that are null or not
in the documents are not used; of several labels of one id the largest counts, and of its rows the least by its
statistics. Without labels of both kinds in
the learning folds the score is the share of good labels (0.5 without any). Ties between splits go to the first
feature and the lowest threshold. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ._base import Index, batches, fold, numbered, utf8, written
from .line_quality import repeated_words

#: The most labelled rows that the fit reads, chosen by a hash of the id.
SAMPLE = 20_000
TREES, DEPTH, BINS, PENALTY = 40, 3, 32, 0.002
THRESHOLD = 0.3

STATISTICS = ("n_words", "word_length", "distinct_share", "top_share", "adjacent_share", "repeat_share", "symbol_share", "bare_symbol_share", "digit_share", "upper_share", "period_share", "short_word_share", "long_word_share", "n_lines", "line_words", "dup_line_share", "mark_share")
_SPACE = b" \t\n\x0b\x0c\r"


def _statistics(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """STATISTICS of the second column, after all columns as they are."""
    kinds = [b"#*$%&|<>", b"0123456789", bytes(range(65, 91)), b".", b"!?,;:"]
    for batch in batches(rows, 400):
        texts = utf8(batch, 1)
        words = [t.split() for t in texts]
        repeats = repeated_words(words)
        out = np.zeros((len(texts), len(STATISTICS)))
        for i, (text, own) in enumerate(zip(texts, words, strict=True)):
            if not own:
                continue
            n, index = len(own), Index()
            ids = numbered(own, index)
            sizes = np.fromiter(map(len, index), np.int64, len(index))
            counts = np.bincount(ids)
            bare = text.translate(None, _SPACE)
            chars = len(bare)
            share = [(chars - len(bare.translate(None, k))) / chars for k in kinds]
            lone = sum(c for w, c in zip(index, counts, strict=True) if not w.translate(None, b"#*$%&|<>-_=+~.")) if share[0] or b"-" in bare else 0
            lines = [x for x in text.split(b"\n") if x.strip()]
            out[i] = (
                n, chars / n, len(index) / n, counts.max() / n, float((ids[1:] == ids[:-1]).sum()) / n, repeats[i] / n, share[0], lone / n, share[1], share[2], share[3],
                counts[sizes <= 3].sum() / n, counts[sizes >= 12].sum() / n, len(lines), n / len(lines), 1 - len(set(lines)) / len(lines), share[4],
            )
        yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(out[:, k]) for k in range(out.shape[1])]], names=[*batch.schema.names, *STATISTICS])


def text_statistics(docs: DataFrame, *, keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, the columns named in `keep`, and STATISTICS for each row of docs (doc_id, text)."""
    own = StructType([T for c in ("doc_id", "text", *[k for k in keep if k != "text"]) for T in docs.schema.fields if T.name == c])
    out = docs.select(own.names).mapInArrow(_statistics, StructType(own.fields + [StructField(x, DoubleType()) for x in STATISTICS]))
    return out if "text" in keep else out.drop("text")


@dataclass(frozen=True)
class RuleModel:
    """score = 1 / (1 + exp(-(intercept + sum of the weights of the rules that hold)))."""

    intercept: float
    rules: tuple[tuple[float, tuple[tuple[str, str, float], ...]], ...]

    def column(self) -> Column:
        total = F.lit(self.intercept)
        for weight, conditions in self.rules:
            holds = F.lit(True)
            for name, side, threshold in conditions:
                holds = holds & ((F.col(name) <= threshold) if side == "<=" else (F.col(name) > threshold))
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def _grow(binned: np.ndarray, target: np.ndarray, rows: np.ndarray, features: np.ndarray, depth: int, path: tuple, found: list, fitted: np.ndarray) -> None:
    """Regression tree by histogram; `path` holds (feature, side, bin)."""
    y = target[rows]
    fitted[rows] = y.mean()
    if path:
        found.append(path)
    if depth == 0 or len(rows) < 40:
        return
    best = (1e-9, -1, -1)
    total, n = y.sum(), len(rows)
    for f in features:
        b = binned[rows, f]
        count, sums = np.bincount(b, minlength=BINS).cumsum()[:-1], np.bincount(b, weights=y, minlength=BINS).cumsum()[:-1]
        ok = (count >= 15) & (count <= n - 15)
        if not ok.any():
            continue
        gain = np.where(ok, sums**2 / np.maximum(count, 1) + (total - sums) ** 2 / np.maximum(n - count, 1) - total**2 / n, 0)
        if gain.max() > best[0]:
            best = (gain.max(), f, int(gain.argmax()))
    _, f, at = best
    if f < 0:
        return
    low = binned[rows, f] <= at
    for side, part in (("<=", low), (">", ~low)):
        _grow(binned, target, rows[part], features, depth - 1, (*path, (f, side, at)), found, fitted)


def _lasso_logistic(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Accelerated proximal gradient; the intercept is not penalised."""
    n, m = x.shape
    x1 = np.ones((n, m + 1))
    x1[:, :m] = x
    v = np.ones(m + 1)
    for _ in range(20):
        v = x1.T @ (x1 @ v)
        v /= np.linalg.norm(v)
    step = 4 * n / float(np.linalg.norm(x1.T @ (x1 @ v)))
    w = z = np.zeros(m + 1)
    t = 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x1 @ z)))
        new = z - step * (x1.T @ (p - y)) / n
        new[:m] = np.sign(new[:m]) * np.maximum(np.abs(new[:m]) - step * penalty, 0)
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        z, w, t = new + (t - 1) / t2 * (new - w), new, t2
    return float(w[m]), w[:m]


def fit_rules(x: np.ndarray, y: np.ndarray, *, seed: int = 7, trees: int = TREES, penalty: float = PENALTY) -> RuleModel:
    """The rule ensemble for the statistics x (rows, STATISTICS) and labels y (0 or 1)."""
    if len(y) == 0 or y.min() == y.max():
        share = 0.5 if len(y) == 0 else (y.sum() + 0.5) / (len(y) + 1)
        return RuleModel(float(np.log(share / (1 - share))), ())
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    raw, paths = np.full(len(y), np.log(y.mean() / (1 - y.mean()))), {}
    for _ in range(trees):
        residual, fitted, found = y - 1 / (1 + np.exp(-raw)), np.zeros(len(y)), []
        rows = np.sort(rng.choice(len(y), max(1, len(y) * 7 // 10), replace=False))
        features = np.sort(rng.choice(x.shape[1], max(2, x.shape[1] * 2 // 3), replace=False))
        _grow(binned, residual, rows, features, DEPTH, (), found, fitted)
        raw = raw + 0.8 * fitted
        paths.update(dict.fromkeys(p for p in found if all(at < len(cuts[f]) for f, _, at in p)))
    held = lambda p: np.logical_and.reduce([(binned[:, f] <= at) if side == "<=" else (binned[:, f] > at) for f, side, at in p])
    kept = list(paths)
    matrix = np.stack([held(p) for p in kept], axis=1) if kept else np.zeros((len(y), 0), bool)
    intercept, weights = _lasso_logistic(matrix, y, penalty)
    rules = tuple((float(w), tuple((STATISTICS[f], side, float(cuts[f][at])) for f, side, at in p)) for w, p in zip(weights, kept, strict=True) if abs(w) > 1e-4)
    return RuleModel(intercept, rules)


def learn(docs: DataFrame, labels: DataFrame, *, target: str = "quality", sample: int = SAMPLE) -> RuleModel:
    """Fit on at most `sample` labelled ids of the learning folds (crc32 of the id mod 5 is not 0)."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull() & (fold(F.col("doc_id")) != 0)).groupBy("doc_id").agg(F.max(target).alias("y"))
    known = written(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "labelled")
    # at most `sample` rows of 12 bytes
    labelled = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    one = text_statistics(labelled, keep=("y",)).groupBy("doc_id", "y").agg(F.min(F.struct(*STATISTICS)).alias("x"))
    got = one.select("doc_id", "y", "x.*").toPandas().sort_values("doc_id")
    return fit_rules(got[list(STATISTICS)].to_numpy(float), (got["y"].to_numpy() > 0).astype(float))


def quality_scores(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs (doc_id, text)."""
    score = learn(docs, labels, sample=sample).column()
    scored = text_statistics(docs).select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
