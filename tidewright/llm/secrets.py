"""Secrets in text: fixed patterns, and a randomness battery for unlabelled strings.

Spans are code points, end exclusive. Fixed patterns (assign, access, hex) are
always reported. Beyond them every run of 24 or more letters, digits and
``+/_-`` is a candidate: its encoding is inferred (hex, base 32, letters and
digits, base 64) and tests compare it with random draws from that
encoding's alphabet. Runs about the middle of the alphabet, serial correlation and
the chi-squared figure of the kinds of characters (capitals, small letters, digits)
must not reject randomness. The chi-squared figure of single characters must be too
small for text, whose letters are uneven by ``UNEVEN`` per character (noncentral
chi-squared, so the test grows sharper with length): ordinary text repeats a letter
with probability ``COINCIDENCE``, which weighs the more the larger the alphabet.
False discoveries are held at ``rate`` by Benjamini and Hochberg's rule within each
encoding and length class, over all candidates of the table, as far as these are text
of that unevenness; the rule reads a histogram of p-values of fixed size. Base 32 and hex
have small alphabets and need longer strings than the others do.

Edge cases: a null text counts as empty and has no spans; repeated rows are
scanned each; an empty table gives an empty result; an input column named like a
result column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewright.llm.common import fresh, whole_text
from tidewright.session import cut_lineage

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{24,}"

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: encoding -> alphabet in order; the first that covers a candidate is taken
ALPHABETS = {
    "hex": (r"^([0-9a-f]+|[0-9A-F]+)$", DIGITS + "abcdef"),
    "base32": (r"^[A-Z2-7]+$", UPPER + "234567"),
    "alnum": (r"^[A-Za-z0-9]+$", UPPER + LOWER + DIGITS),
    "base64": (r"^", UPPER + LOWER + DIGITS + "+/-_"),
}
#: chance that two letters of ordinary English text are equal (its index of coincidence, 1.73 / 26)
COINCIDENCE = 1.73 / 26
#: unevenness per character that ordinary strings are taken to have; few of them are hex,
#: and those are mostly numbers
UNEVEN = {name: len(a) * COINCIDENCE - 1 for name, (_, a) in ALPHABETS.items()} | {"hex": 1.0}
REJECT_Z = 3.3
#: places where the kinds of characters (capitals, small letters, others; in hex digits and
#: letters) end in the alphabet, and the chi-squared figure that one random string in a
#: thousand exceeds with that many kinds
KINDS = {"hex": (10, 16, 10.83), "base32": (26, 32, 10.83), "alnum": (26, 52, 13.82), "base64": (26, 52, 13.82)}
#: length classes start here
LENGTHS = (24, 32, 40, 64, 128)
#: p-values are counted in steps of 1 / P_STEPS of -ln p, up to P_TOP
P_STEPS, P_TOP = 50, 40


def found(text: Column, pattern: str, at: Column | None = None) -> Column:
    """array<struct<start, end, s>> of the leftmost non-overlapping matches: the text is
    cut at the matches, and positions follow from the lengths of both."""
    pieces = F.split(text, pattern, -1)
    empty = F.expr("cast(array() as array<struct<start:int,end:int,s:string>>)")
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))

    def step(acc, x):
        begin = acc["at"] + F.length(x["piece"])
        end = begin + F.length(x["match"])
        span = F.struct(begin.alias("start"), end.alias("end"), x["match"].alias("s"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    pairs = F.filter(F.arrays_zip(pieces.alias("piece"), matches.alias("match")), lambda x: x["match"].isNotNull())
    return F.when(text.rlike(pattern), F.aggregate(pairs, start, step, lambda acc: acc["spans"])).otherwise(empty)


def normal_cdf(z: Column) -> Column:
    """Abramowitz and Stegun 26.2.17; absolute error below 1e-7."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-z * z / 2) / 2.5066282746310002 * poly
    return F.when(z < 0, upper).otherwise(1 - upper)


def encoding_of(s: Column) -> Column:
    out = F.lit("base64")
    for name, (pattern, _) in reversed(list(ALPHABETS.items())[:-1]):
        out = F.when(s.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def by_encoding(enc: Column, value) -> Column:
    """``value`` of the encoding's name."""
    out = value("base64")
    for name in list(ALPHABETS)[:-1]:
        out = F.when(enc == name, value(name)).otherwise(out)
    return out


def battery(spans: Column) -> Column:
    """array<struct<start, end, class, p>> of candidate spans; p is small for strings too
    even for text. Each step adds fields that the next one reads."""

    def named(x):
        enc = encoding_of(x["s"])
        return F.struct(x["start"].alias("start"), x["end"].alias("end"), enc.alias("enc"),
                        F.when(enc == "hex", F.lower(x["s"])).otherwise(x["s"]).alias("s"))

    def valued(x):
        return F.struct(
            x["start"].alias("start"), x["end"].alias("end"), x["enc"].alias("enc"),
            F.length(x["s"]).cast("double").alias("n"),
            by_encoding(x["enc"], lambda e: F.lit(float(len(ALPHABETS[e][1])))).alias("k"),
            F.transform(F.split(x["s"], ""), lambda c: by_encoding(
                x["enc"], lambda e: F.position(c, F.lit(ALPHABETS[e][1])) - 1).cast("double")).alias("v"))

    def total(v, f):
        return F.aggregate(v, F.lit(0.0), lambda acc, y: acc + f(y))

    def mixed(v, n, enc):
        """True unless capitals, small letters and digits are out of proportion."""
        a, b, limit = KINDS[enc]
        k = len(ALPHABETS[enc][1])
        first, second = F.size(F.filter(v, lambda y: y < a)), F.size(F.filter(v, lambda y: (y >= a) & (y < b)))
        seen = [(first, a), (second, b - a), (n - first - second, k - b)]
        chi = sum((got * got * float(k) / (n * float(size)) for got, size in seen if size), F.lit(0.0)) - n
        return chi < limit

    def summed(x):
        v, n = x["v"], x["n"]
        squares = F.transform(F.array_distinct(v), lambda a: F.pow(F.size(F.filter(v, lambda y: y == a)).cast("double"), F.lit(2.0)))
        return F.struct(
            x["start"].alias("start"), x["end"].alias("end"), x["enc"].alias("enc"), n.alias("n"), x["k"].alias("k"), v.alias("v"),
            (total(squares, lambda y: y) * x["k"] / n - n).alias("chi"),
            by_encoding(x["enc"], lambda e: mixed(v, n, e)).alias("mixed"),
            (total(v, lambda y: y) / n).alias("mean"),
            F.transform(v, lambda y: y * 2 >= x["k"]).alias("high"))

    def scored(x):
        v, n, m, high = x["v"], x["n"], x["mean"], x["high"]
        last = n.cast("int") - 1
        changes = F.size(F.filter(F.zip_with(F.slice(high, F.lit(1), last), F.slice(high, F.lit(2), last), lambda a, b: a != b), lambda y: y))
        together = total(F.zip_with(F.slice(v, F.lit(1), last), F.slice(v, F.lit(2), last), lambda a, b: (a - m) * (b - m)), lambda y: y)
        return F.struct(
            x["start"].alias("start"), x["end"].alias("end"), x["enc"].alias("enc"), n.alias("n"), x["k"].alias("k"), x["chi"].alias("chi"), x["mixed"].alias("mixed"),
            (changes + 1).cast("double").alias("runs"),
            F.size(F.filter(high, lambda y: y)).cast("double").alias("n1"),
            together.alias("together"), total(v, lambda y: (y - m) * (y - m)).alias("spread"))

    def judged(x):
        n, n1 = x["n"], x["n1"]
        n0, free, shift = n - n1, x["k"] - 1, n * by_encoding(x["enc"], lambda e: F.lit(UNEVEN[e]))
        expected = 2 * n1 * n0 / n + 1
        variance = (expected - 1) * (expected - 2) / (n - 1)
        runs_z = F.when(variance > 0, F.abs(x["runs"] - expected) / F.sqrt(variance)).otherwise(F.lit(99.0))
        serial_z = F.when(x["spread"] > 0, F.abs(x["together"] / x["spread"]) * F.sqrt(n)).otherwise(F.lit(99.0))
        p = normal_cdf((x["chi"] - free - shift) / F.sqrt(2 * (free + 2 * shift)))
        p = F.when(x["mixed"] & (runs_z < REJECT_Z) & (serial_z < REJECT_Z), p).otherwise(F.lit(1.0))
        length = F.lit(LENGTHS[0])
        for low in LENGTHS[1:]:
            length = F.when(n >= low, F.lit(low)).otherwise(length)
        step = F.least(F.floor(-F.log(F.greatest(p, F.lit(1e-300))) * P_STEPS), F.lit(P_STEPS * P_TOP))
        return F.struct(x["start"].alias("start"), x["end"].alias("end"),
                        F.concat_ws("-", x["enc"], length.cast("string")).alias("class"), step.cast("int").alias("step"))

    for f in (named, valued, summed, scored, judged):
        spans = F.transform(spans, f)
    return spans


def thresholds(candidates: DataFrame, rate: float) -> dict[str, int]:
    """Smallest step of -ln p that Benjamini and Hochberg's rule accepts, by class. There
    are 20 classes at most, so this small table may come to the driver."""
    counts = candidates.groupBy("class", "step").agg(F.count(F.lit(1)).alias("n"))
    passed = counts.select(
        "class", "step",
        F.sum("n").over(W.partitionBy("class").orderBy(F.desc("step"))).alias("found"),
        F.sum("n").over(W.partitionBy("class")).alias("m"),
    ).where(F.exp(-F.col("step") / P_STEPS) * F.col("m") <= rate * F.col("found"))
    return {r["class"]: r["step"] for r in passed.groupBy("class").agg(F.min("step").alias("step")).collect()}


def find_secrets(docs: DataFrame, text_col: str = "text", rate: float = 0.01) -> DataFrame:
    """``docs`` without its text, with secrets: array<struct<kind, start, end>> by start, then
    kind (assign, access, hex, random)."""
    (spans, candidates) = fresh(docs, "spans", "candidates")
    text = whole_text(text_col)
    (body,) = fresh(docs, "body")
    kept = [c for c in docs.columns if c not in (text_col, "secrets")]
    docs = docs.select(*kept, text.alias(body))

    def of_kind(k, source):
        return F.transform(source, lambda x: F.struct(x["start"].alias("start"), F.lit(k).alias("kind"), x["end"].alias("end")))

    text = F.col(body)
    assigned = F.filter(found(text, ASSIGN), lambda x: F.length(F.regexp_extract(x["s"], ASSIGN, 2)) >= 8)
    base = F.concat(of_kind(0, assigned), of_kind(1, found(text, ACCESS)), of_kind(2, found(text, HEX)))
    # one scan of the texts; from here on rows are spans only
    scanned = cut_lineage(docs.select(*kept, base.alias(spans), battery(found(text, CANDIDATE)).alias(candidates)))
    limits = thresholds(scanned.select(F.explode(candidates).alias("c")).select("c.class", "c.step"), rate)
    if limits:
        table = F.create_map(*[F.lit(x) for kv in limits.items() for x in kv])
        extra = F.filter(candidates, lambda x: F.coalesce(x["step"] >= table[x["class"]], F.lit(False)))
    else:
        extra = F.filter(candidates, lambda x: F.lit(False))
    merged = F.array_sort(F.concat(F.col(spans), of_kind(3, extra)))
    kinds = F.array(*[F.lit(k) for k in ("assign", "access", "hex", "random")])
    return scanned.select(*kept, F.transform(merged, lambda x: F.struct(
        F.element_at(kinds, x["kind"] + 1).alias("kind"), x["start"].alias("start"), x["end"].alias("end"))).alias("secrets"))
