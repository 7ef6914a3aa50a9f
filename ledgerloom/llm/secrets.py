"""Secret scan with corpus-wide ownership frequency.

Patterns propose candidate strings; their hashes are counted by the distinct owners and repositories that hold
them. A candidate that one owner has, in few repositories, is live-looking; one that several owners or many
repositories share is a widely copied example. The patterns `assign`, `access` and `hex` are always reported;
long opaque tokens of mixed letters and digits are too common by themselves and are reported (kind `opaque`)
only where ownership shows them to be owner-specific.

Null and empty texts have no spans. A null owner is an owner of its own. Repeated rows have the same repository
and count once. Spans are code points with exclusive ends. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._base import written

KINDS = ("assign", "access", "hex", "opaque")
#: A live-looking secret has one owner and at most this many repositories.
MAX_REPOSITORIES = 3
MASK = "[secret]"
#: Lists of live secrets up to this number of documents and of secrets are broadcast (some 32 MB).
BROADCAST_ROWS = 500_000

_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_OPAQUE = re.compile(r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_-]*[0-9])(?=[a-z0-9_-]*[A-Z])(?=[A-Z0-9_-]*[a-z])[A-Za-z0-9_-]{24,}(?![A-Za-z0-9_+/=-])")


def find(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, secret) of every candidate in a text; `opaque` ones only outside the others."""
    out = [("assign", *m.span(), m[1]) for m in _ASSIGN.finditer(text) if len(m[1]) >= 12]
    if "AKIA" in text:
        out += [("access", *m.span(), m[0]) for m in _ACCESS.finditer(text)]
    out += [("hex", *m.span(), m[0]) for m in _HEX.finditer(text)]
    # of the spans by start, the furthest end so far: a token is free if no span that starts before its end reaches into it
    taken = sorted((a, b) for _, a, b, _ in out)
    starts, ends = [a for a, _ in taken], list(accumulate((b for _, b in taken), max))
    for m in _OPAQUE.finditer(text):
        k = bisect_left(starts, m.end())
        if k == 0 or ends[k - 1] <= m.start():
            out.append(("opaque", *m.span(), m[0]))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def _scan(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    for batch in rows:
        found, digests = [], []
        for t in batch.column(2):
            spans = find(t.as_py() or "")
            found.append([{"kind": k, "start": a, "end": b, "hash": xxhash.xxh3_64_intdigest(s.encode()) - 2**63} for k, a, b, s in spans])
            digests.append(hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b, _ in spans if k != "opaque").encode()).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.string()), pa.array(digests, pa.string()), pa.array(found, _SPANS), *batch.columns[3:]], names=["doc_id", "owner", "base_sha256", "found", *batch.schema.names[3:]])


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("hash", pa.int64())]))


def _judged(docs: DataFrame, owner: str, max_repositories: int, scan, schema: str, key: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The scanned rows, numbered, and one row per reported span with its verdict and the row's key, if given.

    Only the live hashes, each in a few documents, are joined; a widely copied secret is in none of them.
    """
    more = [] if key is None else [key.alias("key")]
    rows = docs.select("doc_id", F.col(owner).alias("owner"), "text", *more).mapInArrow(scan, schema + ", key long" * len(more))
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "secrets")
    each = rows.where(F.size("found") > 0).select("row", "doc_id", "owner", *["key"] * len(more), F.explode("found").alias("s")).select("row", "doc_id", "owner", *["key"] * len(more), "s.*")
    seen = each.select("hash", "owner", "doc_id").distinct().groupBy("hash", "owner").agg(F.count("*").alias("n")).groupBy("hash").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories"))
    live = written(seen.where((F.col("owners") == 1) & (F.col("repositories") <= max_repositories)).select("hash", F.lit(True).alias("is_live")), "live")
    small = live.count() <= BROADCAST_ROWS
    judged = each.join(F.broadcast(live) if small else live, "hash", "left").withColumn("live", F.coalesce("is_live", F.lit(False))).drop("is_live")
    return rows, judged.where((F.col("kind") != "opaque") | F.col("live"))


def scan_secrets(docs: DataFrame, *, owner: str = "source", max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """For each row of docs (doc_id, text, owner): doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied.

    A document is a repository. n_live and n_copied count the reported spans by verdict.
    """
    rows, judged = _judged(docs, owner, max_repositories, _scan, f"doc_id long, owner string, base_sha256 string, {_FOUND}")
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    per_row = judged.groupBy("row").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in KINDS[:3]],
        F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_copied"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind"))), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",").alias("spans"),
    )
    none = {f"n_{k}": 0 for k in KINDS[:3]} | {"n_live": 0, "n_copied": 0, "spans": ""}
    return rows.select("row", "doc_id", "base_sha256").join(per_row, "row", "left").na.fill(none).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_live", "n_copied")


def _masked(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces the secrets of a text whose hashes are in the last column."""
    import xxhash

    for batch in rows:
        k, texts = batch.schema.get_field_index("text"), []
        for t, live in zip(batch.column(k), batch.column(batch.num_columns - 1), strict=True):
            text, live = t.as_py(), set(live.as_py() or ())
            for _, _, end, s in sorted(find(text), key=lambda x: (-x[2], x[1])) if live else ():
                if xxhash.xxh3_64_intdigest(s.encode()) - 2**63 in live and text[end - len(s) : end] == s:
                    text = text[: end - len(s)] + MASK + text[end:]
            texts.append(text)
        columns = list(batch.columns)[:-1]
        columns[k] = pa.array(texts, pa.string())
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])


def redact(docs: DataFrame, *, owner: str = "source", max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """The same rows with MASK in the place of every live-looking secret.

    Verdicts are found first; the texts are then read once more and joined with the live hashes of their own id and text, so that rows
    without an id, or of one id, are told apart, and a row's list is as long as its text allows.
    """
    own = _free_name(docs, "key")
    key = F.xxhash64("doc_id", "text")
    _, judged = _judged(docs, owner, max_repositories, _scan, f"doc_id long, owner string, base_sha256 string, {_FOUND}", key)
    hashes = _free_name(docs, "live")
    live = written(judged.where("live").groupBy(F.col("key").alias(own)).agg(F.collect_set("hash").alias(hashes)), "live")
    small = live.count() <= BROADCAST_ROWS and (live.agg(F.sum(F.size(hashes))).first()[0] or 0) <= BROADCAST_ROWS
    joined = docs.withColumn(own, key).join(F.broadcast(live) if small else live, own, "left").select(*docs.columns, hashes)
    return joined.mapInArrow(_masked, docs.schema)


def _free_name(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name = f"_{name}"
    return name


_FOUND = "found array<struct<kind: string, start: long, end: long, hash: long>>"
