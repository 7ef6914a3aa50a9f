"""Operators 11 to 13 against SQL on whole small tables and against plain loops on odd and hot inputs."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import entries, merkle, ngram_join, phrases
from ledgerloom.llm.transducers import Transducer, union

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(SF).exists(), reason="the driver's tables are not here")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", None, None, None), (None, "no id here at all", "en", "a", 3), (None, "no id here at all", "en", "a", 3), (5, "one", "en", "b", 3), (5, "one", "en", "b", 3), (4, "ONE", None, "b", 3),
    (6, "The quick brown fox jumps over the lazy dog. " * 3000, "en", "a", 1), (7, "Tie tie TIE tie", "en", "a", 1), (8, "x" * 300_000, "en", "b", 1), (10, "é è " * 2000, "fr", "é", 1), (11, "quick brown fox jumps over the lazy dog. the", "und", None, 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    extra = ["key", "part", "block", "cid", "n", "rank", "tree", "level", "pos", "place", "one", "range", "data", "a", "score", "leaf"]
    return spark.createDataFrame(ODD, DOCS).withColumns({c: F.lit("clash") for c in extra})


@needs_data
@pytest.mark.parametrize("name", ["op11_ngram_join", "op12_phrases", "op13_merkle"])
def test_against_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    mine, theirs = entries.queries()[name](spark, SF).toPandas(), con.sql(entries.oracle_sql()[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    cells = lambda df: sorted(map(tuple, df[sorted(df.columns)].values.tolist()), key=str)
    assert cells(mine) == cells(theirs) and len(mine)


# ---- n-gram join


def plain_components(rows, n, percent):
    """component of each row by comparing all pairs of distinct sets."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        k = min(n, len(w))
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset())
    distinct = [s for s in set(sets) if s]
    up = {s: s for s in distinct}

    def root(s):
        while up[s] is not s:
            s = up[s]
        return s

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if 100 * len(a & b) >= percent * len(a | b):
                up[root(a)] = root(b)
    low = {}
    for (doc, _), s in zip(rows, sets, strict=True):
        if s and doc is not None:
            low[root(s)] = min(doc, low.get(root(s), doc))
    return Counter((doc, len(s), low.get(root(s)) if s else doc) for (doc, _), s in zip(rows, sets, strict=True))


def joined(df, **how):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.similar_sets(df, **how).collect())


def test_join_of_odd_rows(spark, odd):
    assert joined(odd, shingle=4, percent=85) == plain_components([(r[0], r[1]) for r in ODD], 4, 85)
    assert joined(odd.limit(0)) == Counter()


@pytest.mark.parametrize("percent", [60, 85])
def test_join_finds_every_link_of_hot_groups(spark, monkeypatch, percent):
    """Near copies of one text by the hundred, chains of changes, texts that share only a passage, a hot n-gram; small blocks and parts."""
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 40)
    monkeypatch.setattr(ngram_join, "PART_GRAMS", 500)
    rng, texts = random.Random(percent), []
    word = lambda: f"w{rng.randrange(400)}"
    base = [word() for _ in range(60)]
    for _ in range(120):
        t = list(base)
        for _ in range(rng.randrange(6)):
            t[rng.randrange(len(t))] = word()
        texts.append(t)
    chain = [word() for _ in range(50)]
    for i in range(40):
        chain = list(chain)
        chain[rng.randrange(50)] = f"c{i}"
        texts.append(chain)
    shared = [word() for _ in range(20)]
    for _ in range(60):
        texts.append(shared + [word() for _ in range(rng.randrange(1, 40))])
    for _ in range(60):
        texts.append([word() for _ in range(rng.randrange(1, 12))])
    texts += [["a", "b", "c", "d"] + [word() for _ in range(rng.randrange(30))] for _ in range(40)] + texts[:30]
    rows = [(i * 7 % 1009, " ".join(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert joined(df, shingle=3, percent=percent) == plain_components(rows, 3, percent)


def test_bounds_leave_similar_pairs(spark):
    """Two sets of 20 that share 18 meet at any place that the order can give; shorter and farther ones don't pass."""
    rows = [(20, 20, 0, 0, True), (20, 20, 2, 2, True), (20, 20, 2, 0, True), (20, 17, 0, 0, True), (20, 16, 0, 0, False), (20, 20, 0, 8, False)]
    df = spark.createDataFrame(rows, "n long, n_head long, pos long, pos_head long, want boolean")
    assert all(r["got"] == r["want"] for r in df.withColumn("got", ngram_join._may_link(85)).collect())


# ---- transducers and phrases


def some_grams(rng, order, n, words=9):
    c = Counter(tuple(b"w%d" % rng.integers(words) for _ in range(order)) for _ in range(n))
    return dict(c)


def transducer(grams):
    words = sorted({w for g in grams for w in g})
    at = {w: i for i, w in enumerate(words)}
    items = sorted(grams.items())
    order = len(items[0][0])
    return Transducer.of(words, np.array([[at[w] for w in g] for g, _ in items]).reshape(-1, order), np.array([n for _, n in items]))


def content(t):
    rows, weights = t.paths()
    return {tuple(t.words[i] for i in r): int(n) for r, n in zip(rows, weights, strict=True)}


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_transducers(order):
    rng = np.random.default_rng(order)
    some = [some_grams(rng, order, n) for n in (1, 5, 80, 500)]
    made = [transducer(g) for g in some]
    for g, t in zip(some, made, strict=True):
        assert content(t) == g and content(Transducer.from_bytes(t.to_bytes())) == g
    whole = sum((Counter(g) for g in some), Counter())
    assert content(union(made)) == whole and content(union([Transducer.from_bytes(union(made).to_bytes()), made[0]])) == whole + Counter(some[0])
    frequent = union(made).at_least(3)
    assert content(frequent) == {g: n for g, n in whole.items() if n >= 3}
    assert content(frequent.at_least(10**9)) == {} and not Transducer.from_bytes(frequent.at_least(10**9).to_bytes()).words
    wanted = some_grams(rng, order, 60, words=12)
    assert transducer(wanted).paths()[0].shape[1] == order
    assert union(made).weights_of(transducer(wanted)).tolist() == [whole.get(g, 0) for g in sorted(wanted)]
    # equal states are stored once: two words with the same continuations
    both = {(b"x", *g[1:]): 1 for g in some[2]} | {(b"y", *g[1:]): 1 for g in some[2]}
    if order > 1:
        assert len(transducer(both).levels[1].start) == 2
    # weights beyond 32 bits
    big = {g: 2**40 for g in some[1]}
    assert content(union([transducer(big), Transducer.from_bytes(transducer(big).to_bytes())])) == {g: 2**41 for g in big}


def test_ranges():
    plan = phrases.Ranges(phrases.Ranges.plan({ord("a") * 256: 5, ord("b") * 256: 30, ord("c") * 256: 3, ord("d") * 256: 4}, 10))
    words = [b"a", b"b", b"c", b"d"]
    where = plan.of(words, np.array([[i] for i in range(4) for _ in range(50)]), np.arange(200, dtype=np.uint64))
    assert set(where[:50]) == {0} and set(where[50:100]) == {1, 2, 3} and set(where[100:]) == {4}


def plain_phrases(rows, least, top):
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for c in ".,;:!?\n\x0b\x0c\r":
            text = text.replace(c, ".")
        for piece in text.split("."):
            w = [x for x in piece.replace("\t", " ").split(" ") if x]
            total[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in cand.items()):
                continue
            score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, total[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(kept)[:top])]
    return sorted(out)


def test_phrases_of_odd_rows(spark, odd, monkeypatch):
    got = sorted(map(tuple, phrases.collocations(odd, least=2).collect()))
    assert got == plain_phrases([(r[2], r[1]) for r in ODD], 2, 2000) and got
    assert phrases.collocations(odd.limit(0)).count() == 0 and phrases.collocations(odd, least=10**6).count() == 0


@pytest.mark.parametrize("top", [5, 2000])
def test_phrases_of_many_shards(spark, monkeypatch, top):
    """Several languages, a hot word, phrases inside phrases, ties; shards and ranges of a few words."""
    monkeypatch.setattr(phrases, "RANGE", 200)
    rng, rows = random.Random(top), []
    for i in range(150):
        w = [rng.choice(["the", "the", "of", "New", "york", "city", "hall", "ß", "zu", "𝄞", "a.b", "x,\ty"] + [f"r{rng.randrange(50)}"]) for _ in range(rng.randrange(40))]
        rows.append((rng.choice(["en", "en", "en", "de", None]), " ".join(w) + (" New York City Hall!" * (i % 3))))
    got = sorted(map(tuple, phrases.collocations(spark.createDataFrame(rows, "lang string, text string").repartition(5), least=3, top=top).collect()))
    assert got == plain_phrases(rows, 3, top)
    # a shard of the tasks' own: the same shards as in the workers, with a bound of a few words
    monkeypatch.setattr(phrases, "SHARD", 50)
    plan = phrases.Ranges.plan({}, 10)
    shard = phrases.Shard(b"en")
    for lang, text in rows:
        if lang == "en":
            shard.add((text or "").encode(), 2)
    everything = np.full(2**phrases.BITS // 8, 255, np.uint8)
    found = union([Transducer.from_bytes(d) for _, _, _, d in shard.rows(2, phrases.Ranges(plan), everything)])
    want = Counter()
    for lang, text in rows:
        if lang == "en":
            w = phrases.words_of(text.encode())
            w = [x for x in w if x]
            want.update((a, b) for a, b in zip(w, w[1:], strict=False) if b"." not in (a, b))
    assert content(found) == dict(want)


# ---- manifest


def plain_manifest(rows):
    sha = lambda *x: hashlib.sha256("".join(x).encode()).hexdigest()
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
        return levels

    def climb(levels, i, folded):
        proof = ""
        for level in levels[:-1]:
            at = i - i % 8
            run = level[at : at + 8]
            proof += "".join(h for j, h in enumerate(run) if j != i % 8)
            folded = sha(*[folded if j == i % 8 else h for j, h in enumerate(run)])
            i //= 8
        return proof, folded

    leaves = defaultdict(list)
    for doc, text, lang, source, n in rows:
        low = None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        leaf, other = (sha(*map(part, (doc, source, lang, n, t))) for t in (text, low))
        hit = zlib.crc32(("" if doc is None else str(doc)).encode()) % 3 == 0
        leaves[lang].append(((doc is not None, doc or 0), leaf, other if hit else leaf))
    langs = sorted(leaves, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: tree([leaf for _, leaf, _ in sorted(leaves[x])]) for x in langs}
    top = tree([trees[x][-1][0] for x in langs])
    out = []
    for j, x in enumerate(langs):
        for i, (doc, leaf, held) in enumerate(sorted(leaves[x])):
            p1, folded = climb(trees[x], i, held)
            p2, folded = climb(top, j, folded)
            out.append((doc[1] if doc[0] else None, leaf, trees[x][-1][0], top[-1][0], sha(p1 + p2), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def manifested(df):
    return sorted(map(tuple, merkle.digest_rows(df).collect()), key=str)


def test_manifest_of_odd_rows(spark, odd):
    got = manifested(odd)
    assert got == plain_manifest(ODD)
    # a lone leaf is its own subroot; alone in the table it is the root
    alone = manifested(odd.where("doc_id = 10"))
    assert alone == plain_manifest([r for r in ODD if r[0] == 10]) and alone[0][1] == alone[0][2] == alone[0][3]
    assert manifested(odd.limit(0)) == []


@pytest.mark.parametrize("most", [0, 12, 200_000])
def test_manifest_of_many_levels(spark, monkeypatch, most):
    """A language of 600 rows and twelve of few, climbed by joins alone, by both ways, and by broadcasts alone."""
    monkeypatch.setattr(merkle, "BROADCAST_NODES", most)
    rows = [(i // 2, f"Text {i % 97}", "en", "s", i) for i in range(600)] + [(i, "Abc" * i, f"l{i % 12}", None, None) for i in range(30)] + [(None, "x", None, "s", 1)] * 9
    assert manifested(spark.createDataFrame(rows, DOCS).repartition(6)) == plain_manifest(rows)
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") != "-1"
