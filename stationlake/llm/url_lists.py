"""Dated URL lists: every capture is judged by the entries of its fetch time.

List entries say that a pattern, a host with everything below it or a host with
the start of a path, is added to or removed from a list at a time. A pattern's
entries in order become validity intervals, from an ``add`` to the next entry.
Of entries of one time ``remove`` comes first, so an ``add`` of that time holds.

The as-of join is an equality join: a capture looks up the keys it could match
(its host's suffixes and its path's prefixes) together with its month, and a
pattern's intervals are kept as one short array for every month they touch. So
a capture meets each pattern once, however often the pattern came and went, and
a host with a third of all captures is split by adaptive execution.

The longest matching pattern decides; of equally long ones ``allow`` goes before
``block``. URLs that are NULL or have no host match nothing, captures without a
fetch time neither. Repeated captures get equal results. Entries without
pattern or time are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.common import step, table

_HOST = "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
_PATH = "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"
_DECORATION = "^.*@|:[0-9]*$"


def host_of(url: Column) -> Column:
    """The lower-case host of a URL, without user and port; NULL if there is none."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, _HOST, 1)), _DECORATION, "")
    return F.when(host != "", host)


def url_keys(url: Column) -> Column:
    """All patterns that would match a URL: host suffixes, then path prefixes.

    A host that ends with the dot of the root has the patterns with and without it.
    """

    def keys(p: Column) -> Column:
        labels, parts = p["labels"], p["parts"]
        suffixes = F.transform(
            F.sequence(F.lit(1), F.size(labels)),
            lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
        )
        prefixes = F.when(
            F.size(parts) > 0,
            F.transform(
                F.sequence(F.lit(1), F.size(parts)),
                lambda i: F.concat(p["host"], F.lit("/"), F.array_join(F.slice(parts, 1, i), "/")),
            ),
        ).otherwise(F.array().cast("array<string>"))
        return F.concat(F.filter(suffixes, lambda x: x != ""), prefixes)

    host = host_of(url)
    bare = F.regexp_replace(host, "\\.$", "")
    parts = F.filter(F.split(F.regexp_extract(url, _PATH, 1), "/"), lambda x: x != "")
    names = F.filter(F.array_distinct(F.array(bare, host)), lambda h: h != "")
    known = F.transform(
        names,
        lambda h: F.struct(h.alias("host"), F.split(h, "\\.").alias("labels"), parts.alias("parts")),
    )
    return F.when(host.isNotNull(), F.flatten(F.transform(known, keys))).otherwise(F.array().cast("array<string>"))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """list, verdict, pattern, valid_from, valid_to (NULL: still valid).

    ``entries``: list, verdict (allow or block), pattern, action (add or
    remove), dated. An ``add`` of what is on the list already changes nothing.
    """
    named = ["list", "verdict", "pattern"]
    usable = entries.filter(F.col("pattern").isNotNull() & F.col("dated").isNotNull())
    # Of one time, "add" holds against "remove".
    at = usable.groupBy(*named, "dated").agg(F.max((F.col("action") == "add").cast("int")).alias("on"))
    in_order = Window.partitionBy(*named).orderBy("dated")
    turns = at.withColumn("was", F.lag("on").over(in_order)).filter(
        F.col("was").isNull() | (F.col("was") != F.col("on"))
    )
    return (
        turns.withColumn("valid_to", F.lead("dated").over(in_order))
        .filter(F.col("on") == 1)
        .select(*named, F.col("dated").alias("valid_from"), "valid_to")
    )


def _month(time: Column) -> Column:
    return (F.year(time) * 12 + F.month(time)).cast("int")


def interval_index(intervals: DataFrame, months: list[int]) -> DataFrame:
    """(pattern, month, held): the intervals that touch a month, for the given
    months only, however long an interval stays open."""
    first = _month(F.col("valid_from"))
    last = F.coalesce(_month(F.col("valid_to")), F.lit((1 << 31) - 1))
    asked = F.array(*(F.lit(m) for m in months)).cast("array<int>")
    touched = F.filter(asked, lambda m: (m >= first) & (m <= last))
    held = F.struct("list", "verdict", "valid_from", "valid_to")
    return (
        intervals.select("pattern", F.explode(touched).alias("month"), held.alias("held"))
        .groupBy("pattern", "month")
        .agg(F.collect_list("held").alias("held"))
    )


def judged(captures: DataFrame, entries: DataFrame, id_column: str = "page_id") -> DataFrame:
    """id, url, fetched_at of every capture, with n_active, decision, decided_by."""
    own = [id_column, "url", "fetched_at"]
    asked = captures.select(*own)
    # The months that captures have: of the calendar, so never many.
    found_months = asked.select(_month(F.col("fetched_at")).alias("m")).distinct().collect()
    months = sorted(r["m"] for r in found_months if r["m"] is not None)
    index = step(interval_index(validity_intervals(entries), months), "list-index")
    looked_up = asked.distinct().select(
        *own, F.explode(url_keys(F.col("url"))).alias("pattern"), _month(F.col("fetched_at")).alias("month")
    )
    at = F.col("fetched_at")
    active = F.filter(
        "held",
        lambda h: (h["valid_from"] <= at) & (h["valid_to"].isNull() | (at < h["valid_to"])),
    )
    matched = looked_up.join(index, ["pattern", "month"]).withColumn("active", active)
    allowed = F.exists("active", lambda h: h["verdict"] == "allow").cast("int")
    found = (
        matched.filter(F.size("active") > 0)
        .groupBy(*own)
        .agg(
            F.sum(F.size("active")).cast("long").alias("n_active"),
            F.max(F.struct(F.length("pattern").alias("n"), allowed.alias("allowed"), "pattern")).alias("best"),
        )
        .select(*(F.col(c).alias(f"f_{c}") for c in own), "n_active", "best")
    )
    same = [asked[c].eqNullSafe(found[f"f_{c}"]) for c in own]
    decision = (
        F.when(F.col("best").isNull(), "none").when(F.col("best.allowed") == 1, "allow").otherwise("block")
    )
    return asked.join(found, same, "left").select(
        *own,
        F.coalesce("n_active", F.lit(0).cast("long")).alias("n_active"),
        decision.alias("decision"),
        F.col("best.pattern").alias("decided_by"),
    )


# --- captures and lists derived from the page table -------------------------

_START = "TIMESTAMP_NTZ '2024-01-01 00:00:00'"


def derived_captures(spark, sf_dir: str) -> DataFrame:
    """Pages with a fetch time spread over a year by page_id."""
    return table(spark, sf_dir, "pages").selectExpr(
        "page_id",
        "url",
        f"timestampadd(MINUTE, CAST(pmod(page_id * 7919, 525600) AS INT), {_START}) AS fetched_at",
    )


def derived_entries(captures: DataFrame) -> DataFrame:
    """Entries about the hosts, domains and sections of the captured URLs, dated
    by digests: blocked hosts that come and go, allowed domains, blocked sections."""
    number = "CAST(conv(substr(md5(pattern), 1, 6), 16, 10) AS INT)"
    day = lambda n: f"timestampadd(DAY, {n}, {_START})"
    named = captures.select(host_of(F.col("url")).alias("host"), url_keys(F.col("url")).alias("keys"))

    def rows(patterns: DataFrame, name: str, verdict: str, when: dict[str, tuple[str, str]]) -> DataFrame:
        events = ", ".join(
            f"IF({keep}, named_struct('action', '{action}', 'dated', {day(at)}), NULL)"
            for keep, (action, at) in when.items()
        )
        return (
            patterns.filter("pattern IS NOT NULL")
            .distinct()
            .withColumn("n", F.expr(number))
            .select(
                F.lit(name).alias("list"),
                F.lit(verdict).alias("verdict"),
                "pattern",
                F.explode(F.expr(f"array({events})")).alias("e"),
            )
            .filter("e IS NOT NULL")
            .select("list", "verdict", "pattern", "e.action", "e.dated")
        )

    hosts = named.select(F.col("host").alias("pattern"))
    domains = named.select(F.substring_index("host", ".", -2).alias("pattern"))
    sections = named.select(F.explode("keys").alias("pattern"), "host").filter(
        "pattern LIKE '%/%' AND size(split(pattern, '/')) = 2"
    )
    first = "n % 366"
    return (
        rows(
            hosts,
            "hosts",
            "block",
            {
                "n % 3 <> 0": ("add", first),
                "n % 3 <> 0 AND n % 5 <> 0": ("remove", f"{first} + 30 + n % 90"),
                "n % 2 = 0": ("add", f"{first} + 200"),
            },
        )
        .unionByName(
            rows(
                domains,
                "domains",
                "allow",
                {"n % 2 = 0": ("add", first), "n % 4 = 0": ("remove", f"{first} + 60")},
            )
        )
        .unionByName(rows(sections.select("pattern"), "sections", "block", {"n % 5 = 0": ("add", first)}))
    )


def url_filters(spark, sf_dir: str) -> DataFrame:
    captures = derived_captures(spark, sf_dir)
    return judged(captures, derived_entries(captures))


ORACLE = """
WITH captures AS (
  SELECT page_id, url, TIMESTAMP '2024-01-01' + to_minutes((page_id * 7919) % 525600) AS fetched_at,
         nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)),
                               '^.*@|:[0-9]*$', '', 'g'), '') AS host,
         list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '/'),
                     lambda x: x <> '') AS parts
  FROM pages),
patterns AS (
  SELECT DISTINCT 'hosts' AS list, 'block' AS verdict, host AS pattern FROM captures WHERE host IS NOT NULL
  UNION SELECT DISTINCT 'domains', 'allow', array_to_string(string_split(host, '.')[-2:], '.')
  FROM captures WHERE host IS NOT NULL
  UNION SELECT DISTINCT 'sections', 'block', host || '/' || parts[1]
  FROM captures WHERE host IS NOT NULL AND len(parts) > 0),
numbered AS (SELECT *, ('0x' || substr(md5(pattern), 1, 6))::INT AS n FROM patterns),
entries AS (
  SELECT list, verdict, pattern, 'add' AS action, n % 366 AS day FROM numbered
  WHERE (list = 'hosts' AND n % 3 <> 0) OR (list = 'domains' AND n % 2 = 0) OR (list = 'sections' AND n % 5 = 0)
  UNION ALL SELECT list, verdict, pattern, 'remove', n % 366 + 30 + n % 90 FROM numbered
  WHERE list = 'hosts' AND n % 3 <> 0 AND n % 5 <> 0
  UNION ALL SELECT list, verdict, pattern, 'add', n % 366 + 200 FROM numbered WHERE list = 'hosts' AND n % 2 = 0
  UNION ALL SELECT list, verdict, pattern, 'remove', n % 366 + 60 FROM numbered
  WHERE list = 'domains' AND n % 4 = 0),
dated AS (SELECT *, TIMESTAMP '2024-01-01' + to_days(CAST(day AS INT)) AS at FROM entries),
states AS (
  SELECT c.page_id, c.url, c.fetched_at, d.list, d.verdict, d.pattern,
         arg_max(d.action, struct_pack(a := d.at, b := CASE d.action WHEN 'add' THEN 1 ELSE 0 END)) AS state
  FROM (SELECT DISTINCT * FROM captures) c JOIN dated d
    ON d.at <= c.fetched_at
   AND (c.host = d.pattern OR ends_with(c.host, '.' || d.pattern)
        OR (contains(d.pattern, '/') AND starts_with(c.host || '/' || array_to_string(c.parts, '/') || '/', d.pattern || '/')))
  GROUP BY ALL),
best AS (
  SELECT page_id, url, fetched_at, count(*) AS n_active,
         max(struct_pack(n := length(pattern), a := CASE verdict WHEN 'allow' THEN 1 ELSE 0 END, p := pattern)) AS best
  FROM states WHERE state = 'add' GROUP BY ALL)
SELECT c.page_id, c.url, c.fetched_at, coalesce(n_active, 0)::BIGINT AS n_active,
       CASE WHEN best IS NULL THEN 'none' WHEN best.a = 1 THEN 'allow' ELSE 'block' END AS decision,
       best.p AS decided_by
FROM captures c LEFT JOIN best b ON c.page_id IS NOT DISTINCT FROM b.page_id
 AND c.url IS NOT DISTINCT FROM b.url AND c.fetched_at IS NOT DISTINCT FROM b.fetched_at
"""
