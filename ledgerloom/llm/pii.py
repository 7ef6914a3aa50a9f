"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust the score.

DataFrame operations only. The positions of matches come from the lengths of the matches and of the pieces
between them. Every pattern may start only where the run of its characters starts or the last match ended, which
gives the same matches as without that and keeps the time linear in long runs.

Kinds: email, ip, card (Luhn), phone; the method adds iban (as long as its country's are, mod 97). A confirmed span has a base score by kind,
raised by CONTEXT_GAIN where a context word of its kind stands in the CONTEXT_CHARS before or after it.

Null and empty texts have no spans. Repeated rows are scored each by itself. Spans are code points with
exclusive ends. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "iban")
#: Characters of an IBAN by country; those of no country here have 15 to 34.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_known = "|".join("|".join(c.split()) for c in IBAN_LENGTHS.values())
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"\b(?=[A-Z]{2}[0-9]{2})(?:" + "|".join(rf"(?:{'|'.join(c.split())})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items()) + rf"|(?!{_known})[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]){{11,30}})\b",
}
#: What a text must hold for its kind to be looked for at all.
NEEDS = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9]"),
    "phone": lambda t: F.contains(t, F.lit("+")),
    "iban": lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}"),
}
BASE_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.95}
CONTEXT_WORDS = {
    "email": "(?i)e-?mail|contact|write to",
    "ip": "(?i)address|server|host|login|\\bip\\b",
    "card": "(?i)card|visa|payment|credit|account",
    "phone": "(?i)phone|call|mobile|tel\\b|fax",
    "iban": "(?i)iban|bank|account|transfer",
}
CONTEXT_CHARS, CONTEXT_GAIN = 40, 0.1
#: Matches of a text whose places are found together.
BLOCK = 128

_digits = lambda s: F.regexp_replace(s, r"[^0-9]", "")


def luhn(s: Column) -> Column:
    """Whether the digits of a string pass the Luhn check."""
    doubled = lambda d, i: F.when((i % 2) == 1, F.when(2 * d > 9, 2 * d - 9).otherwise(2 * d)).otherwise(d)
    each = F.transform(F.split(F.reverse(_digits(s)), ""), lambda c: c.cast("int"))
    return F.aggregate(F.transform(F.filter(each, lambda d: d.isNotNull()), doubled), F.lit(0), lambda a, d: a + d) % 10 == 0


def mod97(s: Column) -> Column:
    """Whether an IBAN's check digits are right."""
    bare = F.regexp_replace(s, " ", "")
    turned = F.concat(F.substring(bare, 5, 64), F.substring(bare, 1, 4))
    value = lambda c: F.position(c, F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ")) - 1
    step = lambda a, v: F.when(v < 10, a * 10 + v).otherwise(a * 100 + v) % 97
    return F.aggregate(F.transform(F.filter(F.split(turned, ""), lambda c: c != ""), value), F.lit(0), step) == 1


def _valid(kind: str, s: Column) -> Column:
    n = F.length(_digits(s))
    return {
        "email": lambda: F.lit(True),
        "ip": lambda: F.forall(F.split(s, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.lpad(F.ltrim(p, F.lit("0")), 3, "0") <= "255")),
        "card": lambda: (n >= 13) & (n <= 19) & luhn(s),
        "phone": lambda: (n >= 9) & (n <= 15),
        "iban": lambda: mod97(s),
    }[kind]()


def _let(value: Column, body) -> Column:
    """body(value), with the value computed once."""
    return F.transform(F.array(value), body)[0]


_SPAN = "struct<start: int, end: int, value: string, near: string>"


def spans_of(kind: str, text: Column) -> Column:
    """array<struct<start, end, value, near>> of the confirmed spans of one kind in a text; near: the CONTEXT_CHARS before and after."""
    found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    cut = F.struct(found.alias("found"), F.split(text, PATTERNS[kind], -1).alias("between"))
    last, first = lambda s: F.right(s, F.lit(CONTEXT_CHARS)), lambda s: F.left(s, F.lit(CONTEXT_CHARS))

    def match(z: Column, m: Column, i: Column) -> Column:
        piece = lambda name, k: F.get(z[name], k)
        before = last(F.concat_ws("", last(piece("between", i - 1)), last(piece("found", i - 1)), last(piece("between", i))))
        after = first(F.concat_ws("", first(piece("between", i + 1)), first(piece("found", i + 1)), first(piece("between", i + 2))))
        return F.struct(m.alias("value"), F.length(piece("between", i)).alias("gap"), F.concat_ws("\n", before, after).alias("near"))

    none = lambda at, of: F.struct(at.alias("at"), F.expr(f"cast(array() as {of})").alias("spans"))
    begin = lambda acc, p: acc["at"] + p["gap"]
    end = lambda acc, p: begin(acc, p) + F.length(p["value"])
    put = lambda acc, p: F.struct(end(acc, p).alias("at"), F.concat(acc["spans"], F.array(F.struct(begin(acc, p).alias("start"), end(acc, p).alias("end"), p["value"], p["near"]))).alias("spans"))

    def placed(matches: Column) -> Column:
        # arrays are copied when they grow, so matches are placed in blocks and the blocks gathered
        block = lambda acc, k: F.aggregate(F.slice(matches, k * BLOCK + 1, BLOCK), none(acc["at"], f"array<{_SPAN}>"), put)
        add = lambda acc, k: _let(block(acc, k), lambda r: F.struct(r["at"].alias("at"), F.concat(acc["spans"], F.array(r["spans"])).alias("spans")))
        blocks = F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / BLOCK).cast("int"))
        return F.when(F.size(matches) > 0, F.aggregate(blocks, none(F.lit(0), f"array<array<{_SPAN}>>"), add, lambda acc: F.flatten(acc["spans"])))

    every = _let(_let(cut, lambda z: F.transform(z["found"], lambda m, i: match(z, m, i))), placed)
    return F.when(NEEDS[kind](text), F.filter(every, lambda s: _valid(kind, s["value"])))


def find_pii(docs: DataFrame) -> DataFrame:
    """For each row of docs (doc_id, text): doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_iban, scores.

    `scores` holds one score per span, in the order of `spans`.
    """
    text = F.coalesce("text", F.lit(""))
    empty = F.expr(f"cast(array() as array<{_SPAN}>)")
    rows = docs.select("doc_id", text.alias("text")).select("doc_id", "text", *[F.coalesce(spans_of(k, F.col("text")), empty).alias(k) for k in KINDS])
    shown = lambda k: F.transform(k, lambda s: F.concat_ws(":", F.lit(k), s["start"], s["end"]))
    base = F.concat(*[shown(k) for k in KINDS[:4]])
    score = lambda k: F.transform(k, lambda s: F.round(F.lit(BASE_SCORE[k]) + F.when(s["near"].rlike(CONTEXT_WORDS[k]), F.lit(CONTEXT_GAIN)).otherwise(F.lit(0.0)), 3))
    return rows.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:4]],
        F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"), F.array_join(F.concat(base, shown("iban")), ",").alias("spans"),
        F.size("iban").cast("long").alias("n_iban"), F.concat(*[score(k) for k in KINDS]).alias("scores"),
    )
