"""Mixing sources to target weights by Pareto order sampling.

A source's target is a share of all words by its weight, at most ``CAP`` times
its own words; what a source cannot take is shared again by weight. Every
document of a source is wanted ``target / words`` times: the whole part is
allotted to all, the rest is an inclusion probability p. Documents are ranked by
random odds over inclusion odds, ``(u / (1 - u)) / (p / (1 - p))``, and taken in
that order until the words of the source come nearest to its target.

Random numbers are digests of document id and text, so reruns agree. Rows equal
in both are taken together. A source or text of NULL is a source of its own
(last) or an empty text. A source without words has target 0.

No source is ever gathered: its cut is found by two rounds of a histogram with
``BINS`` bins, and only the ranks of one bin of a bin are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.common import forget, step, text_of, words_of

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3.0
BINS = 4096
SEED = "mix-1"
_UNIT = 1 << 52
_WORKING = "size digest copies copy source_size target plan_source rate cut inclusive whole p".split()


def sized(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Adds ``size`` (words) and ``digest`` (the document's random number)."""
    keep = docs.columns if keep is None else keep
    identity = F.concat_ws("|", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))
    return docs.select(
        *keep,
        F.size(words_of(text_of())).cast("long").alias("size"),
        F.md5(F.concat(identity, F.lit("|"), text_of())).alias("digest"),
    )


def bits(size: Column) -> Column:
    """Binary digits of a size, 1 to 63: how much a document is wanted."""
    return F.length(F.bin(size))


def size_classes(sizes: DataFrame) -> DataFrame:
    """``words`` by source and number of binary digits, at most 64 rows a source."""
    return sizes.groupBy("source", bits(F.col("size")).alias("bits")).agg(F.sum("size").alias("words"))


def source_targets(classes: DataFrame, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """One row per source: ``source_size``, ``weight``, ``target``.

    Sources are capped in the order in which rising shares reach their caps, so
    one running sum over the source list settles all rounds of sharing again.
    The windows without partitions run over one row per source.
    """
    totals = classes.groupBy("source").agg(F.sum("words").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(
        F.array(*(F.lit(float(w)) for w in weights)), (place % len(weights) + 1).cast("int")
    )
    ranked = totals.withColumn("weight", weight)
    most = F.lit(float(cap)) * F.col("source_size")
    filling = Window.orderBy((most / F.col("weight")), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    left_words = F.sum("source_size").over(everything) - F.lit(float(cap)) * F.coalesce(
        F.sum("source_size").over(before), F.lit(0)
    )
    left_weight = F.sum("weight").over(everything) - F.coalesce(
        F.sum("weight").over(before), F.lit(0.0)
    )
    leveled = ranked.withColumns(
        {"level": left_words / left_weight, "turn": F.row_number().over(filling)}
    ).withColumn("capped", F.col("level") > most / F.col("weight"))
    # Sources that fill up alike have turns of their own: only the first one's level counts.
    first = F.min(F.when(~F.col("capped"), F.struct("turn", "level"))).over(everything)["level"]
    target = F.when(F.col("capped") | first.isNull(), most).otherwise(first * F.col("weight"))
    return leveled.select("source", "source_size", "weight", target.alias("target"))


def copies_wanted(rate: Column, digits: Column, cap: float = CAP) -> Column:
    return F.least(F.lit(float(cap)), rate * digits)


def source_rates(classes: DataFrame, targets: DataFrame, cap: float = CAP) -> DataFrame:
    """``targets`` with each source's ``rate`` and the words ``missing`` from its
    target after the certain copies.

    Classes of long documents reach the cap first. With the first j of them at
    the cap, the others share what is left of the target; the rate is that of
    the first j that lifts no other class above the cap.
    """
    named = targets.select(F.col("source").alias("of"), "source_size", "weight", "target")
    given = classes.filter(F.col("words") > 0).join(named, F.col("source").eqNullSafe(F.col("of")))
    longest = Window.partitionBy("source").orderBy(F.col("bits").desc())
    above = F.coalesce(
        F.sum("words").over(longest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    below = F.sum(F.col("words") * F.col("bits")).over(
        longest.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    )
    tried = given.withColumn("rate", (F.col("target") - F.lit(float(cap)) * above) / below)
    fits = (F.col("rate") * F.col("bits") <= cap) & (F.col("target") < F.lit(float(cap)) * F.col("source_size"))
    found = tried.groupBy("source").agg(
        F.coalesce(F.max_by("rate", F.when(fits, F.col("bits"))), F.lit(float(cap))).alias("rate")
    )
    found = found.select(F.col("source").alias("with"), "rate")
    certain = (
        given.join(found, F.col("source").eqNullSafe(F.col("with")))
        .withColumn("certain", F.col("words") * F.floor(copies_wanted(F.col("rate"), F.col("bits"), cap)))
        .groupBy("source")
        .agg(F.max("rate").alias("rate"), F.sum("certain").alias("certain"))
        .select(F.col("source").alias("with"), "rate", "certain")
    )
    return targets.join(certain, F.col("source").eqNullSafe(F.col("with")), "left").select(
        "source",
        "source_size",
        "weight",
        "target",
        F.coalesce("rate", F.lit(0.0)).alias("rate"),
        (F.col("target") - F.coalesce("certain", F.lit(0))).alias("missing"),
    )


def pareto_rank(digest: Column, p: Column) -> Column:
    """Random odds over inclusion odds, q, as q / (1 + q) in [0, 1]."""
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / _UNIT
    odds, wanted = u / (1 - u), p / (1 - p)
    return F.when(p > 0, odds / (odds + wanted)).otherwise(1.0)


def _bin(rank: Column, level: int) -> Column:
    """The level-th digit of a rank to the base ``BINS``."""
    scaled = rank * float(BINS**level)
    digit = F.floor(scaled) - F.floor(rank * float(BINS ** (level - 1))) * BINS
    return F.least(digit, F.lit(BINS - 1)).cast("int")


def _crossing(bins: DataFrame, digit: str) -> DataFrame:
    """Per source the bin in which the running words pass what is missing, and
    the words of the bins before it. At most ``BINS`` rows a source."""
    running = F.sum("words").over(Window.partitionBy("source").orderBy(digit))
    return (
        bins.withColumn("upto", running)
        .filter(F.col("upto") >= F.col("missing"))
        .groupBy("source")
        .agg(F.min(F.struct(digit, (F.col("upto") - F.col("words")).alias("before"))).alias("at"))
    )


def cuts(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with the last rank taken in each source: ``cut`` (a struct of
    rank and digest), NULL where none is."""
    wanted = targets.select(F.col("source").alias("s"), "rate", "missing")
    ranked = (
        sizes.filter(F.col("size") > 0)
        .join(wanted, sizes["source"].eqNullSafe(F.col("s")))
        .withColumn("copies", copies_wanted(F.col("rate"), bits(F.col("size"))))
        .withColumn("p", F.col("copies") - F.floor("copies"))
        .filter(F.col("p") > 0)
        .select("source", "size", "digest", "missing", pareto_rank(F.col("digest"), F.col("p")).alias("rank"))
        .withColumns({"b1": _bin(F.col("rank"), 1), "b2": _bin(F.col("rank"), 2)})
    )
    first = _crossing(
        ranked.groupBy("source", "b1").agg(F.sum("size").alias("words"), F.first("missing").alias("missing")),
        "b1",
    ).select(F.col("source").alias("s1"), F.col("at.b1").alias("c1"), F.col("at.before").alias("before1"))
    inside = (
        ranked.join(first, F.col("source").eqNullSafe(F.col("s1")) & (F.col("b1") == F.col("c1")))
        .withColumn("missing", F.col("missing") - F.col("before1"))
        .drop("s1", "c1", "before1")
    )
    second = _crossing(
        inside.groupBy("source", "b2").agg(F.sum("size").alias("words"), F.first("missing").alias("missing")),
        "b2",
    ).select(F.col("source").alias("s2"), F.col("at.b2").alias("c2"), F.col("at.before").alias("before2"))
    # The last bin holds about 1 / BINS ** 2 of a source; equal ranks are one row.
    last = (
        inside.join(second, F.col("source").eqNullSafe(F.col("s2")) & (F.col("b2") == F.col("c2")))
        .groupBy("source", "rank", "digest")
        .agg(
            F.sum("size").alias("words"),
            F.first(F.col("missing") - F.col("before2")).alias("missing"),
        )
    )
    in_order = Window.partitionBy("source").orderBy("rank", "digest")
    upto = F.sum("words").over(in_order)
    placed = last.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("words"))
    at = F.struct("rank", "digest")
    # Taken when that comes nearer to the target than stopping before it.
    taken = (F.col("before") < F.col("missing")) & (
        F.col("upto") - F.col("missing") <= F.col("missing") - F.col("before")
    )
    last_cut = placed.groupBy(F.col("source").alias("s3")).agg(
        F.max(F.when(taken, at)).alias("cut"), F.min(at).alias("next")
    )
    # Nothing of the last bin taken: the cut lies just before its first rank.
    return (
        targets.join(last_cut, F.col("source").eqNullSafe(F.col("s3")), "left")
        .drop("s3")
        .select(
            *targets.columns,
            F.coalesce(F.col("cut"), F.col("next")).alias("cut"),
            F.col("cut").isNotNull().alias("inclusive"),
        )
    )


def mixing_plan(sizes: DataFrame, weights=WEIGHTS) -> DataFrame:
    """The stored plan, one row per source. ``sizes``: source, size, digest."""
    classes = step(size_classes(sizes), "mix-classes")
    targets = step(source_rates(classes, source_targets(classes, weights)), "mix-targets")
    plan = step(cuts(sizes, targets), "mix-plan")
    forget(classes, targets)
    return plan


def allot(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """``sizes`` with its source's plan and the ``copies`` of each document."""
    renamed = plan.select(
        F.col("source").alias("plan_source"),
        F.col("source_size"),
        "target",
        "rate",
        "cut",
        "inclusive",
    )
    wanted = copies_wanted(F.col("rate"), bits(F.col("size")))
    rank = F.struct(pareto_rank(F.col("digest"), F.col("p")).alias("rank"), "digest")
    extra = F.when(
        (F.col("p") > 0) & ((rank < F.col("cut")) | (F.col("inclusive") & (rank == F.col("cut")))), 1
    ).otherwise(0)
    return (
        sizes.join(renamed, F.col("source").eqNullSafe(F.col("plan_source")))
        .withColumns({"whole": F.floor(wanted), "p": wanted - F.floor(wanted)})
        .withColumn("copies", F.when(F.col("size") > 0, F.col("whole") + extra).otherwise(0).cast("long"))
        .drop("plan_source", "rate", "whole", "p", "cut", "inclusive")
    )


def mix(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken, copies, source."""
    sizes = step(sized(docs, ["doc_id", "source"]), "mix-sizes")
    return allot(sizes, mixing_plan(sizes)).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "copies",
        "source",
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: every document as many times as it is taken."""
    names = docs.columns
    aside = set(_WORKING) & {name.lower() for name in names}
    if aside:  # names that clash with working columns travel in a struct
        docs = docs.select(F.struct(*names).alias("document"), "doc_id", "text", "source")
        names = ["document.*"]
    sizes = step(sized(docs, ["doc_id", "source"]).drop("doc_id"), "mix-sizes")
    plan = mixing_plan(sizes)
    forget(sizes)
    return (
        allot(sized(docs), plan)
        .filter(F.col("copies") > 0)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select(*names)
    )


ORACLE = """
WITH sized AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), '-') || '|' || coalesce(text, '')) AS digest
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS s,
         [5.0::DOUBLE, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM sized GROUP BY source),
filling AS (
  SELECT *, row_number() OVER (ORDER BY 3.0::DOUBLE * s / w, source NULLS LAST) AS turn,
         ((sum(s) OVER ())::DOUBLE - 3.0::DOUBLE * coalesce(sum(s) OVER b, 0)::DOUBLE)
            / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level
  FROM sources
  WINDOW b AS (ORDER BY 3.0::DOUBLE * s / w, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
share AS (
  SELECT arg_min(level, turn) AS level FROM filling
  WHERE level <= 3.0::DOUBLE * s / w),
targets AS (
  SELECT source, s, CASE WHEN f.level > 3.0::DOUBLE * s / w OR share.level IS NULL
                         THEN 3.0::DOUBLE * s ELSE share.level * w END AS target
  FROM filling f, share),
classes AS (
  SELECT source, length(bin(size)) AS bits, CAST(sum(size) AS BIGINT) AS words
  FROM sized WHERE size > 0 GROUP BY ALL),
tried AS (
  SELECT c.*, target, s,
         (target - 3.0::DOUBLE * coalesce(sum(words) OVER above, 0)::DOUBLE)
         / (sum(words * bits) OVER below)::DOUBLE AS rate
  FROM classes c JOIN targets t ON c.source IS NOT DISTINCT FROM t.source
  WINDOW above AS (PARTITION BY c.source ORDER BY bits DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         below AS (PARTITION BY c.source ORDER BY bits DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
rates AS (
  SELECT source, coalesce(arg_max(rate, bits) FILTER (rate * bits <= 3 AND target < 3.0::DOUBLE * s), 3.0) AS rate
  FROM tried GROUP BY source),
wanted AS (
  SELECT t.source, t.s, t.target, coalesce(any_value(r.rate), 0) AS rate,
         t.target - coalesce(sum(words * floor(least(3.0::DOUBLE, r.rate * bits))), 0) AS missing
  FROM targets t LEFT JOIN rates r ON t.source IS NOT DISTINCT FROM r.source
       LEFT JOIN classes c ON t.source IS NOT DISTINCT FROM c.source
  GROUP BY t.source, t.s, t.target),
doc AS (
  SELECT d.doc_id, d.source, d.size, d.digest, w.s, w.target, w.missing,
         least(3.0::DOUBLE, rate * length(bin(size))) AS copies,
         (CAST('0x' || digest[1:13] AS BIGINT)::DOUBLE + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM sized d JOIN wanted w ON d.source IS NOT DISTINCT FROM w.source),
ranked AS (
  SELECT *, CAST(floor(copies) AS BIGINT) AS whole, copies - floor(copies) AS p, size > 0 AND p > 0 AS drawn,
         CASE WHEN p > 0 THEN (u / (1 - u)) / ((u / (1 - u)) + p / (1 - p)) END AS rank
  FROM doc),
running AS (
  SELECT *, CASE WHEN drawn THEN sum(size) OVER (PARTITION BY source, drawn ORDER BY rank, digest) END AS upto,
         sum(size) OVER (PARTITION BY source, drawn, rank, digest) AS own
  FROM ranked)
SELECT doc_id, CAST(size AS BIGINT) AS size, s AS source_size, target, source,
       CAST(CASE WHEN size = 0 THEN 0 ELSE whole + extra END AS BIGINT) AS copies,
       CAST(size * (CASE WHEN size = 0 THEN 0 ELSE whole + extra END) AS BIGINT) AS taken
FROM (SELECT *, CASE WHEN drawn AND upto - own < missing
                      AND upto - missing <= missing - (upto - own) THEN 1
                     WHEN drawn AND upto <= missing THEN 1 ELSE 0 END AS extra
      FROM running)
"""
