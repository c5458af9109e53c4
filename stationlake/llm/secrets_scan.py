"""Secret scan: known forms, and tokens that pass a battery of randomness tests.

Known forms are leftmost, non-overlapping matches per kind (``KINDS``). Beyond
them every long token is read in the smallest alphabet that holds it, and tested
for three things that random strings show and words do not: uniform use of the
alphabet (chi-squared), changes between its lower and upper half (runs), and no
correlation of neighbours (serial). Fisher's sum of the three p-values is the
token's ``deviance``, small for random strings: theirs is chi-squared with six
degrees of freedom.

Short tokens pass such tests by chance, the more so the shorter they are. How
often, two things tell:

* Theory: a string of as many letters with the frequencies of ``LETTERS`` has a
  chi-squared value that is noncentral. It bounds the probability that such a
  string has a deviance as small as the token's. The bound goes by length and
  alphabet, so it means the same in all classes and needs no other token.
* Decoys: as many letters of the text before a token, read in the same alphabet,
  get the same bound. Counted per alphabet and length class, or over neighbouring
  length classes where they are few, they correct it.

A class's p-value counts its decoys and one more, of which the theoretical part
lies below. A token without enough letters before it has no decoy, and its
p-value is never less than the theoretical one. One cut is made for all classes
together, so that at most ``FALSE_SHARE`` of what lies below it is expected to be
false (Benjamini and Hochberg, p-values weighted by the odds that a class's token
is not random, as in Hu, Zhao and Zhou's grouped form). Tokens below it are reported as ``random``,
unless they touch a known form; those whose deviance random strings reach with a
probability below ``RANDOM_LEVEL`` never are.

All of it is built-in functions over arrays; spans are code points, end
exclusive. NULL texts are empty. What is kept between the passes is one row per
document with its matches.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import bound, step, text_of

FALSE_SHARE = 0.05
RANDOM_LEVEL = 1e-4
FEW_DECOYS = 100
PRIOR = 5  # tokens with the corpus's share of random ones that each class is given
BINS_PER_DECADE = 20  # of theoretical p-values
LEAST_P = 1e-30
LEAST_TOKEN = 20
TOKEN = f"[A-Za-z0-9+/_=-]{{{LEAST_TOKEN},}}"
BLOCK = 128  # matches of a text that are worked on together
CONTEXT = 4  # decoys are taken from so many times the token's length before it


@dataclass(frozen=True)
class Kind:
    name: str
    find: str  # Java pattern
    group: int  # whose length counts
    least: int


# The known forms, in the order in which equal starts are listed.
KINDS = [
    Kind(
        "assign",
        "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        12,
    ),
    Kind("access", "AKIA[A-Z0-9]+", 0, 18),
    Kind("hex", "[0-9a-f]{16,}", 0, 16),
]

# Alphabets from small to large; the first that holds a token is its encoding.
ALPHABETS = {
    "digits": "0123456789",
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "lower": "abcdefghijklmnopqrstuvwxyz0123456789",
    "alnum": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
    "mixed": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_=",
}
#: Percent of English text, a to z.
LETTERS = [
    8.17, 1.49, 2.78, 4.25, 12.7, 2.23, 2.02, 6.09, 6.97, 0.15, 0.77, 4.03, 2.41,
    6.75, 7.51, 1.93, 0.1, 5.99, 6.33, 9.06, 2.76, 0.98, 2.36, 0.15, 1.97, 0.07,
]


def _excess(size: int) -> float:
    """Noncentrality a symbol of such letters in an alphabet of that size."""
    shares = [sum(LETTERS[s::size]) / sum(LETTERS) for s in range(size)]
    return size * sum(p * p for p in shares) - 1


EXCESS = {name: _excess(len(letters)) for name, letters in ALPHABETS.items()}
#: Upper ends of the length classes.
LENGTHS = [24, 32, 48, 64, 96, 128, 1 << 30]


def _in_blocks(items: Column, body) -> Column:
    """``body(part)`` for every ``BLOCK`` items, as an array: work that grows with
    the square of an array is done within small parts of it."""
    last = F.greatest(F.ceil(F.size(items) / BLOCK).cast("int") - 1, F.lit(0))
    starts = F.filter(F.sequence(F.lit(0), last), lambda i: i * BLOCK < F.size(items))
    return F.transform(starts, lambda i: bound(F.slice(items, i * BLOCK + 1, BLOCK), body))


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: array of (first, end, value).

    The text between matches gives their places: it is what ``split`` returns.
    Places are summed up within blocks, then blocks within the text.
    """
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    spans = "array<struct<first:int,end:int,value:string>>"

    def placed(part: Column) -> Column:
        """How far a block reaches, and its matches as counted from its start."""

        def add(acc: Column, x: Column) -> Column:
            first = acc["at"] + F.length(x["gap"])
            end = first + F.length(x["value"])
            one = F.struct(first.alias("first"), end.alias("end"), x["value"].alias("value"))
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

        return F.aggregate(part, F.struct(F.lit(0).alias("at"), F.array().cast(spans).alias("out")), add)

    def joined(blocks: Column) -> Column:
        starts = F.aggregate(
            blocks,
            F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
            lambda acc, x: F.struct(
                (acc["at"] + x["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")
            ),
            lambda acc: acc["out"],
        )

        def moved(x: Column) -> Column:
            at = x["start"]
            return F.transform(
                x["block"]["out"],
                lambda m: F.struct(
                    (at + m["first"]).alias("first"), (at + m["end"]).alias("end"), m["value"].alias("value")
                ),
            )

        return F.flatten(F.transform(F.arrays_zip(starts.alias("start"), blocks.alias("block")), moved))

    def with_gaps(both: Column) -> Column:
        found = both["found"]
        pairs = F.arrays_zip(F.slice(both["between"], 1, F.size(found)).alias("gap"), found.alias("value"))
        return bound(bound(pairs, lambda items: _in_blocks(items, placed)), joined)

    both = F.struct(F.split(text, pattern, -1).alias("between"), values.alias("found"))
    return F.when(F.regexp_like(text, F.lit(pattern)), bound(both, with_gaps)).otherwise(F.array().cast(spans))


def known_spans(text: Column, kind: Kind, rank: int) -> Column:
    """The matches of a kind that are long enough: (first, rank, end)."""
    measured = (
        (lambda v: F.length(F.regexp_extract(v, kind.find, kind.group)))
        if kind.group
        else (lambda v: F.length(v))
    )
    return F.transform(
        F.filter(matches(text, kind.find), lambda m: measured(m["value"]) >= kind.least),
        lambda m: F.struct(m["first"].alias("first"), F.lit(rank).alias("rank"), m["end"].alias("end")),
    )


# --- the battery ------------------------------------------------------------


def _encoding(value: Column) -> Column:
    """The name of the smallest alphabet that holds a token without its padding."""
    found = F.lit("mixed")
    for name, letters in reversed(list(ALPHABETS.items())[:-1]):
        found = F.when(F.regexp_like(value, F.lit(f"^[{re.escape(letters)}]*$")), F.lit(name)).otherwise(found)
    return found


def _alphabet(encoding: Column) -> Column:
    """What the battery asks of an encoding: its ``letters``, the ``half`` each of
    them lies in, its ``size``, and the letter that stands for each of a to z."""

    def entry(letters: str) -> Column:
        size = len(letters)
        return F.struct(
            F.lit(letters).alias("letters"),
            F.lit("".join("01"[2 * i >= size] for i in range(size))).alias("half"),
            F.lit(size).alias("size"),
            F.lit("".join(letters[i % size] for i in range(26))).alias("a_to_z"),
        )

    pairs = (x for name, letters in ALPHABETS.items() for x in (F.lit(name), entry(letters)))
    return F.element_at(F.create_map(*pairs), encoding)


def _normal_tail(z: Column) -> Column:
    """P(|Z| > |z|), by a logistic form that is within 0.0002."""
    return bound(F.abs(z), lambda a: F.greatest(2 / (1 + F.exp(1.5976 * a + 0.07056 * a * a * a)), F.lit(1e-12)))


def _upper_tail(z: Column) -> Column:
    return bound(z, lambda z: F.greatest(1 / (1 + F.exp(1.5976 * z + 0.07056 * z * z * z)), F.lit(1e-12)))


def _without(text: Column, part) -> Column:
    """How many characters go with every ``part``."""
    return F.length(text) - F.length(F.replace(text, part, F.lit("")))


def deviance(token: Column) -> Column:
    """Fisher's sum for a struct (value: letters of the alphabet; alphabet).

    Time grows with the length: all moments come from one count per letter of
    the alphabet, from two letters for the halves, and from one pass over
    neighbours for their products.
    """

    def counted(t: Column) -> Column:
        value, letters = t["value"], t["alphabet"]["letters"]
        symbols = F.transform(F.split(value, ""), lambda c: F.instr(letters, c) - 1)

        def neighbours(x: Column) -> Column:
            products = F.zip_with(x, F.slice(x, 2, F.size(x) - 1), lambda a, b: a * b)
            total = F.aggregate(products, F.lit(0.0), lambda a, v: a + F.coalesce(v, F.lit(0)))
            return F.struct(
                total.alias("products"), F.element_at(x, 1).alias("first"), F.element_at(x, -1).alias("last")
            )

        return F.struct(
            F.length(value).cast("double").alias("n"),
            t["alphabet"]["size"].cast("double").alias("k"),
            F.transform(F.split(letters, ""), lambda s: _without(value, s).cast("double")).alias("counts"),
            F.call_function("translate", value, letters, t["alphabet"]["half"]).alias("halves"),
            bound(symbols, neighbours).alias("next"),
        )

    def summed(t: Column) -> Column:
        def total(of) -> Column:
            return F.aggregate(F.transform(t["counts"], of), F.lit(0.0), lambda a, v: a + v)

        # Neither "01" nor "10" overlaps itself, so what goes with them counts them.
        changes = (_without(t["halves"], F.lit("01")) + _without(t["halves"], F.lit("10"))) / 2
        return F.struct(
            t["n"].alias("n"),
            t["k"].alias("k"),
            total(lambda c: c * c).alias("squares"),
            total(lambda c, s: c * s).alias("total"),
            total(lambda c, s: c * s * s).alias("power"),
            _without(t["halves"], F.lit("1")).cast("double").alias("upper"),
            changes.alias("changes"),
            t["next"].alias("next"),
        )

    def battery(t: Column) -> Column:
        n, k = t["n"], t["k"]
        chi = t["squares"] * k / n - n
        # Wilson and Hilferty: the cube root of chi-squared over its freedom is near normal.
        free = k - 1
        uniform = _upper_tail((F.cbrt(chi / free) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free)))

        expected = 2 * t["upper"] * (n - t["upper"]) / n + 1
        spread = (expected - 1) * (expected - 2) / (n - 1)
        runs = bound(
            F.struct(expected.alias("expected"), spread.alias("spread")),
            lambda r: F.when(
                r["spread"] > 0, _normal_tail((t["changes"] + 1 - r["expected"]) / F.sqrt(r["spread"]))
            ).otherwise(F.lit(1e-12)),
        )

        # Sums of (v - mean)^2 and of (a - mean)(b - mean) over neighbours, multiplied out.
        mean, ends = t["total"] / n, t["next"]["first"] + t["next"]["last"]
        variance = t["power"] - t["total"] * t["total"] / n
        product = t["next"]["products"] - mean * (2 * t["total"] - ends) + (n - 1) * mean * mean
        serial = F.when(variance > 0, _normal_tail(product / variance * F.sqrt(n))).otherwise(F.lit(1e-12))
        return -2 * (F.log(uniform) + F.log(runs) + F.log(serial))

    return bound(bound(bound(token, counted), summed), battery)


def _score(found: Column, encoding: Column, length: Column, size: Column) -> Column:
    """Decades of the theoretical p-value of a deviance; 0 for what is not random.

    A deviance of at most d needs a uniformity p-value of at least exp(-d / 2),
    so a chi-squared value of at most c; what letters have is noncentral
    (Wilson and Hilferty's form for it by Abdel-Aty).
    """

    def decades(v: Column) -> Column:
        half, free = v["d"] / 2, v["k"] - 1
        random = F.exp(-half) * (1 + half + half * half / 2)
        # The normal quantile of exp(-d / 2): the root of _upper_tail's cubic.
        odds = F.log(F.greatest(F.expm1(half), F.lit(1e-12)))
        a, b = 1.5976 / 0.07056, odds / 0.07056
        z = 2 * math.sqrt(a / 3) * F.sinh(F.asinh(3 * b / (2 * a) * math.sqrt(3 / a)) / 3)
        root = F.greatest(1 - 2 / (9 * free) + z * F.sqrt(2 / (9 * free)), F.lit(0.0))
        mean = free + v["n"] * v["excess"]
        freedom = mean * mean / (mean + v["n"] * v["excess"])

        def low(r: Column) -> Column:
            y = (F.cbrt(free * r * r * r / mean) - (1 - 2 / (9 * freedom))) / F.sqrt(2 / (9 * freedom))
            return bound(
                y, lambda y: 1 / (1 + F.exp(F.least(-(1.5976 * y + 0.07056 * y * y * y), F.lit(700.0))))
            )

        return F.when(random >= RANDOM_LEVEL, -F.log10(F.greatest(bound(root, low), F.lit(LEAST_P)))).otherwise(0.0)

    pairs = (F.lit(x) for item in EXCESS.items() for x in item)
    return bound(
        F.struct(
            found.alias("d"),
            size.cast("double").alias("k"),
            length.cast("double").alias("n"),
            F.element_at(F.create_map(*pairs), encoding).alias("excess"),
        ),
        decades,
    )


def _decoy(around: Column, length: Column, a_to_z: Column) -> Column:
    """The last letters of the text before a token, as letters of its alphabet."""
    letters = F.regexp_replace(F.lower(around), "[^a-z]+", "")
    return F.call_function("translate", F.right(letters, length), F.lit(ALPHABETS["lower"][:26]), a_to_z)


def _length_class(length: Column) -> Column:
    found = F.lit(len(LENGTHS) - 1)
    for i in range(len(LENGTHS) - 2, -1, -1):
        found = F.when(length <= LENGTHS[i], F.lit(i)).otherwise(found)
    return found


def tokens(text: Column) -> Column:
    """Every long token: (first, end, encoding, length_class, score, decoy)."""

    def tested(m: Column, before: Column, start: Column) -> Column:
        """A match, and the part of the text from ``start`` on that lies before it."""

        def parts(p: Column) -> Column:
            bare, length, alphabet = p["bare"], F.length(p["bare"]), p["alphabet"]
            reach = CONTEXT * F.length(m["value"])
            first = F.greatest(m["first"] - reach, F.lit(0))
            around = F.substring(before, first - start + 1, m["first"] - first)

            def score(value: Column) -> Column:
                found = deviance(F.struct(value.alias("value"), alphabet.alias("alphabet")))
                return _score(found, p["encoding"], length, alphabet["size"])

            both = F.array(bare, _decoy(around, length, alphabet["a_to_z"]))
            scores = F.transform(both, lambda value: F.when(F.length(value) >= length, score(value)))
            return bound(
                scores,
                lambda got: F.struct(
                    m["first"].alias("first"),
                    m["end"].alias("end"),
                    p["encoding"].alias("encoding"),
                    _length_class(F.length(m["value"])).alias("length_class"),
                    got[0].alias("score"),
                    got[1].alias("decoy"),
                ),
            )

        def encoded(bare: Column) -> Column:
            return bound(
                _encoding(bare),
                lambda name: bound(
                    F.struct(name.alias("encoding"), bare.alias("bare"), _alphabet(name).alias("alphabet")), parts
                ),
            )

        return bound(F.rtrim(m["value"], F.lit("=")), encoded)

    def block(part: Column) -> Column:
        """The text before a block's tokens is cut out once: places in a long
        text are found by counting from its start."""
        reaches = F.transform(part, lambda m: m["first"] - CONTEXT * F.length(m["value"]))
        start = F.greatest(F.array_min(reaches), F.lit(0))
        end = F.element_at(part, -1)["first"]
        cut = F.struct(start.alias("start"), F.substring(text, start + 1, end - start).alias("before"))
        return bound(cut, lambda c: F.transform(part, lambda m: tested(m, c["before"], c["start"])))

    usable = F.filter(matches(text, TOKEN), lambda m: F.length(F.rtrim(m["value"], F.lit("="))) >= 8)
    return F.flatten(bound(usable, lambda found: _in_blocks(found, block)))


def _bin(score: Column) -> Column:
    return F.floor(score * BINS_PER_DECADE).cast("int")


def counts(found: DataFrame) -> DataFrame:
    """Tokens by encoding, length_class, has_decoy, and bin of their score; decoys
    by the bin of theirs. At most some 600 bins a class, whatever the corpus."""
    each = found.select(F.explode("tokens").alias("t")).select("t.*")
    has = F.col("decoy").isNotNull()
    one = F.struct(has.alias("has_decoy"), _bin(F.col("score")).alias("bin"), F.lit(1).alias("token"), F.lit(0).alias("decoy"))
    other = F.struct(has.alias("has_decoy"), _bin(F.col("decoy")).alias("bin"), F.lit(0).alias("token"), F.lit(1).alias("decoy"))
    return (
        each.select("encoding", "length_class", F.explode(F.array(one, other)).alias("s"))
        .filter("s.bin IS NOT NULL")
        .groupBy("encoding", "length_class", "s.has_decoy", "s.bin")
        .agg(F.sum("s.token").alias("tokens"), F.sum("s.decoy").alias("decoys"))
    )


def bounds(counted: list, false_share: float = FALSE_SHARE) -> dict[tuple[str, int, bool], int]:
    """Per encoding, length class and has_decoy the least bin that is reported."""
    decoys: dict = {}
    for r in counted:
        decoys.setdefault((r["encoding"], r["length_class"]), Counter())[r["bin"]] += r["decoys"]

    def pooled(encoding: str, length_class: int) -> tuple[list[int], list[int]]:
        """Bins of decoys in order, and how many decoys lie in each or above."""
        for reach in range(len(LENGTHS)):
            near = Counter()
            for c in range(length_class - reach, length_class + reach + 1):
                near.update(decoys.get((encoding, c), {}))
            if near.total() >= FEW_DECOYS:
                break
        bins = sorted(b for b, n in near.items() if n)
        above = list(accumulate(near[b] for b in reversed(bins)))[::-1] + [0]
        return bins, above

    tables = {key: pooled(*key) for key in decoys}
    rows = []
    for r in counted:
        if not r["tokens"]:
            continue
        key, at = (r["encoding"], r["length_class"]), r["bin"]
        theory = 10 ** (-at / BINS_PER_DECADE)
        bins, above = tables[key]
        # Bin 0 also has what is not random.
        p = (above[bisect_left(bins, at)] + theory) / (above[0] + 1) if at else 1.0
        rows.append((p if r["has_decoy"] else max(p, theory), (*key, r["has_decoy"]), at, r["tokens"]))

    size, high = Counter(), Counter()
    for p, key, _, n in rows:
        size[key] += n
        high[key] += n * (p > 0.5)
    overall = min(1.0, 2 * (high.total() + 1) / max(size.total(), 1))
    # The share of a class that is not random, and at least one token that is.
    null = {
        key: min((2 * high[key] + PRIOR * overall) / (n + PRIOR), 1 - 1 / (n + PRIOR)) for key, n in size.items()
    }
    budget = sum(n * (1 - null[key]) for key, n in size.items())
    ranked = sorted(
        (p * null[key] / (1 - null[key]), key, at, n) for p, key, at, n in rows if at and p <= false_share
    )
    upto, cut = 0, -1
    for i, (weighted, _, _, n) in enumerate(ranked):
        upto += n
        if weighted * budget <= false_share * upto:
            cut = i
    least: dict = {}
    for _, key, at, _ in ranked[: cut + 1]:
        least[key] = min(at, least.get(key, at))
    return least


# --- results ----------------------------------------------------------------


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, base (known spans) and tokens, for every document."""
    text = text_of(F.col("text").cast("string"))
    known = [known_spans(F.col("_text"), kind, i) for i, kind in enumerate(KINDS)]
    found = docs.select(F.col("doc_id").cast("long"), text.alias("_text")).select(
        "doc_id", F.array_sort(F.concat(*known)).alias("base"), tokens(F.col("_text")).alias("tokens")
    )

    def number(rank: int) -> Column:
        return F.size(F.filter("base", lambda b: b["rank"] == rank)).cast("long")

    return found.select(
        "doc_id", "base", *(number(i).alias(f"n_{kind.name}") for i, kind in enumerate(KINDS)), "tokens"
    )


def secrets(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, base spans, their numbers, and ``spans`` with the
    added ones, all as (first, rank, end) in order; rank ``len(KINDS)`` is random."""
    found = step(scanned(docs), "secret-scan")
    # Some 600 rows per encoding, length class and has_decoy at most.
    listed = list(bounds(counts(found).collect()).items())

    def within(t: Column) -> Column:
        ok = F.lit(False)
        for (encoding, length_class, has_decoy), least in listed:
            ok = ok | (
                (t["encoding"] == encoding)
                & (t["length_class"] == length_class)
                & (t["decoy"].isNotNull() == has_decoy)
                & (_bin(t["score"]) >= least)
            )
        return ok

    def added(part: Column) -> Column:
        """The tokens of a block that are random and touch no known form."""
        low, high = F.element_at(part, 1)["first"], F.element_at(part, -1)["end"]
        near = F.filter("base", lambda b: (b["first"] < high) & (low < b["end"]))

        def apart(known: Column) -> Column:
            free = F.filter(
                part, lambda t: ~F.exists(known, lambda b: (b["first"] < t["end"]) & (t["first"] < b["end"]))
            )
            return F.transform(
                free,
                lambda t: F.struct(t["first"].alias("first"), F.lit(len(KINDS)).alias("rank"), t["end"].alias("end")),
            )

        return bound(near, apart)

    random = F.flatten(bound(F.filter("tokens", within), lambda found: _in_blocks(found, added)))
    return found.withColumn("spans", F.array_sort(F.concat("base", random)))


def _as_text(spans: Column) -> Column:
    names = F.array(*(F.lit(k.name) for k in KINDS), F.lit("random"))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(names, s["rank"] + 1), s["first"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def secret_scan(docs: DataFrame) -> DataFrame:
    return secrets(docs).select(
        "doc_id",
        *(f"n_{k.name}" for k in KINDS),
        F.sha2(_as_text(F.col("base")), 256).alias("base_sha256"),
        _as_text(F.col("spans")).alias("spans"),
    )
