"""Personal data: patterns propose spans, checksums confirm them, nearby context words adjust the score.

Everything is DataFrame expressions on the row; there is no shuffle. Base kinds are accepted by pattern and check alone:
``email``, ``ip`` (parts at most 255), ``card`` (14 to 19 digits, Luhn), ``phone`` (leading +, 10 to 15 digits). The
method adds ``iban`` (length of its country, mod-97) and ``local_phone`` (national notation without +, which needs a context word). A span's score is
its kind's ``SCORE`` plus ``CONTEXT_GAIN`` if one of the kind's context words stands in the ``CONTEXT_CHARS`` characters
before it; spans scoring at least ``ACCEPT`` are kept.

Spans are code points, end exclusive. Patterns use possessive loops, which neither recurse nor backtrack, so very long
runs of digits or letters are linear and safe.

Defined results: null and empty texts have no spans; rows are independent, so repeated rows and ties change nothing;
extra columns stay inside ``doc``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.arrays import whole
from ledgerloom.scale import computed_once

KINDS = ("email", "ip", "card", "phone", "iban", "local_phone")
BASE = KINDS[:4]
_LOCAL = "A-Za-z0-9._%+-"
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Length of an account number by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD FK", 19: "MK SI", 20: "AT BA EE KZ LT LU XK MN", 21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM TL SO", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST AO CV GW MZ", 26: "IS TR DZ IR",
    27: "BI DJ FR GR IT MC MR SM CF CG CM GA GQ KM MG TD",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV BF BJ CI MA ML NE SN TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN = "|".join(rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items())
_OTHER = rf"(?!{'|'.join(' '.join(IBAN_LENGTHS.values()).split())})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}}+"
#: An address can only begin where the run of its characters begins, or right after the address before it (\G).
PATTERNS = {
    "email": rf"((?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)",
    "ip": r"((?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3})",
    "card": r"([0-9](?:[\x20-]?[0-9]){13,}+)",
    "phone": r"(\+[0-9][\x20().0-9-]+[0-9])",
    "iban": rf"(?<![A-Za-z0-9])(?=((?:{_IBAN}|{_OTHER})(?![A-Za-z0-9])))[A-Z]",
    "local_phone": r"((?<![0-9+().-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9]))",
}
#: Kinds whose matches take one letter and look ahead for the value: what fails its check hides nothing behind it.
AHEAD = ("iban",)
#: A text without this never matches, which spares it the search.
NEEDED = {"email": "@", "phone": "+"}
SCORE = {"email": 0.9, "ip": 0.7, "card": 0.9, "phone": 0.8, "iban": 0.9, "local_phone": 0.4}
CONTEXT = {
    "email": "mail|contact|write", "ip": "host|server|address|ip", "card": "card|visa|credit|payment|cc",
    "phone": "phone|tel|call|mobile|fax", "iban": "iban|account|bank|transfer", "local_phone": "phone|tel|call|mobile|fax",
}
CONTEXT_CHARS = 40
CONTEXT_GAIN = 0.3
ACCEPT = 0.6


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _mod_97(x: Column) -> Column:
    """Remainder of an account number, letters as 10 to 35, first four characters last; nine digits at a time."""
    plain = F.regexp_replace(x, " ", "")
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))
    value = lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.aggregate(
        F.split(turned, ""), F.lit(0),
        lambda acc, c: F.when(c == "", acc).when(c.rlike("[0-9]"), (acc * 10 + value(c)) % 97).otherwise((acc * 100 + value(c)) % 97),
    )


def _confirmed(kind: str, x: Column) -> Column:
    if kind == "ip":
        return x.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return F.length(_digits(x)).between(14, 19) & F.call_function("luhn_check", _digits(x))
    if kind == "phone":
        return F.length(_digits(x)).between(10, 15)
    if kind == "iban":
        return F.length(F.regexp_replace(x, " ", "")).between(15, 34) & (_mod_97(x) == 1)
    return F.lit(True)


def _proposed(kind: str, text: Column) -> Column:
    """Spans of a pattern: lengths of the matches and of what stands between them give the positions."""
    found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(1))
    between = F.split(text, PATTERNS[kind], -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.length(x["value"])
        # Only confirmed spans are carried, so the array stays as short as the result.
        span = F.struct(begin.alias("start"), end.alias("end"), x["value"].alias("value"))
        return F.struct((begin + 1 if kind in AHEAD else end).alias("at"), F.when(_confirmed(kind, x["value"]), F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    # The last gap has no match behind it and is cut off.
    pairs = F.slice(F.arrays_zip(between.alias("gap"), found.alias("value")), 1, F.size(found))
    spans = F.aggregate(pairs, start, step, lambda acc: acc["spans"])
    before = lambda s: F.lower(F.substr(text, F.greatest(s["start"] - CONTEXT_CHARS + 1, F.lit(1)), F.least(s["start"], F.lit(CONTEXT_CHARS))))
    scored = F.transform(spans, lambda s: F.struct(
        F.lit(KINDS.index(kind)).alias("kind_no"), F.lit(kind).alias("kind"), s["start"], s["end"], s["value"],
        F.least(F.lit(1.0), F.lit(SCORE[kind]) + F.when(before(s).rlike(rf"(?:^|[^a-z])(?:{CONTEXT[kind]})"), CONTEXT_GAIN).otherwise(0.0)).alias("score"),
    ))
    kept = F.filter(scored, lambda s: s["score"] >= ACCEPT)
    shape = "array<struct<kind_no:int,kind:string,start:int,end:int,value:string,score:double>>"
    possible = text.contains(NEEDED[kind]) if kind in NEEDED else text.rlike("[0-9]")
    return F.when(possible, kept).otherwise(F.array().cast(shape)).cast(shape)


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document: ``doc`` and ``spans`` (kind, start, end, value, score), by start, then as in ``KINDS``."""
    body = F.coalesce(F.col("doc").getField(text).cast("string"), F.lit(""))
    rows = docs.select(whole(docs)).select("doc", body.alias("body"))
    found = computed_once(rows.select("doc", *[_proposed(k, F.col("body")).alias(k) for k in KINDS]), keys=["doc"])
    merged = F.sort_array(F.transform(
        F.concat(*KINDS), lambda s: F.struct(s["start"], s["kind_no"], s["kind"], s["end"], s["value"], s["score"])
    ))
    return found.select("doc", merged.alias("spans"))


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind in brackets; of overlapping spans the first names the place."""
    body = F.coalesce(F.col("doc").getField(text).cast("string"), F.lit(""))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        label = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        gap = F.substr(body, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, label)).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    clean = F.aggregate(F.col("spans"), start, step, lambda acc: F.concat(acc["out"], F.substr(body, acc["at"] + 1)))
    new = F.when(F.size("spans") > 0, clean).otherwise(F.col("doc").getField(text))
    return find_pii(docs, text).select(*[(new if c == text else F.col("doc").getField(c)).alias(c) for c in docs.columns])
