"""URL filters: host and path rules, and pattern rules indexed by their rarest literal token.

Host and path rules decide first: a rule fits its host and all subdomains if the url's path starts
with the rule's, and the longest one wins. All other urls are judged by pattern rules: each regular
expression names literal tokens that must stand in any url it matches; it is filed under the
one that is rarest among the urls' own tokens. A url's tokens fetch the rules filed under them, and only
those are run. A match blocks, a match of an exception rule allows; no match allows.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to
``?``, ``#`` or the end. A null url or one without ``://`` has neither and fits no host rule; the patterns judge it like any other (a null
url is allowed).
Equal urls are judged once; repeated rows and a null ``page_id`` keep their rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The rules of the contract.
SITE_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


@dataclass(frozen=True)
class Pattern:
    """A rule: its expression is run on the lower-cased url, and every one of its tokens stands in a url it matches."""

    name: str
    regex: str
    tokens: tuple[str, ...]
    allow: bool = False


# Advertising, gambling, adult, pharmacy and link-farm hosts, and tracking redirects.
PATTERNS = (
    Pattern("gambling-casino", r"://([a-z0-9-]+\.)*([a-z0-9]+-)*casino(-[a-z0-9]+)*\.", ("casino",)),
    Pattern("gambling-bets", r"://([a-z0-9-]+\.)*([a-z0-9]+-)*bets(-[a-z0-9]+)*\.", ("bets",)),
    Pattern("pharmacy", r"://([a-z0-9-]+\.)*([a-z0-9]+-)*pills(-[a-z0-9]+)*\.", ("pills",)),
    Pattern("adult", r"://([a-z0-9-]+\.)*adult-x\.", ("adult", "x")),
    Pattern("ads-track", r"://([a-z0-9-]+\.)*ads-track\.", ("ads", "track")),
    Pattern("link-farm", r"://([a-z0-9-]+\.)*spam-farm\.", ("spam", "farm")),
    Pattern("ad-server", r"://([a-z0-9-]+\.)*adserver\.", ("adserver",)),
    Pattern("ad-click", r"://([a-z0-9-]+\.)*doubleclick\.", ("doubleclick",)),
    Pattern("banner-path", r"/banner/[^?#]*\.(gif|png|jpe?g)", ("banner",)),
    Pattern("banners-path", r"/banners/[^?#]*\.(gif|png|jpe?g)", ("banners",)),
    Pattern("affiliate", r"[?&]affiliate(_id)?=", ("affiliate",)),
    Pattern("redirect", r"/redirect/?\?(.*&)?url=https?(%3a|:)", ("redirect", "url")),
    Pattern("spam-archive", r"://archive\.[a-z0-9.-]*/spam-farm/", ("archive", "spam", "farm"), True),
)


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def site_rule(host: Column, path: Column, rules=SITE_RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest fitting rule; nulls where none fits. The rules are few and become one expression."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, site, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == site) | F.endswith(host, F.lit("." + site))) & F.startswith(path, F.lit(start))
        name, verdict = F.when(fits, site + start).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def tokens(url: Column) -> Column:
    """The distinct runs of a-z and 0-9 in a lower-cased url."""
    return F.array_distinct(F.filter(F.split(url, "[^a-z0-9]+"), lambda t: t != ""))


def _index(urls: DataFrame, patterns) -> DataFrame:
    """``token``, ``regex``, ``name``, ``allow``: each rule under its rarest token, a rule without tokens under none."""
    spark = urls.sparkSession
    rows = [(p.name, p.regex, p.allow, token) for p in patterns for token in (p.tokens or (None,))]
    rules = spark.createDataFrame(rows, "name string, regex string, allow boolean, token string")
    named = rules.select("token").filter("token is not null").distinct()
    counts = (urls.select(F.explode(tokens(F.col("url_lower"))).alias("token")).join(named, "token", "left_semi")
              .groupBy("token").agg(F.count("*").alias("n")))
    ranked = rules.join(counts, "token", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return ranked.groupBy("name", "regex", "allow").agg(F.min(F.struct("n", "token")).getField("token").alias("token"))


def pattern_verdicts(urls: DataFrame, patterns=PATTERNS) -> DataFrame:
    """``url``, ``pattern``, ``verdict`` of distinct urls (column ``url``) that a pattern matches.

    An exception rule wins over the others; among equals the least name is reported.
    """
    lower = urls.select("url", F.translate("url", UPPER, LOWER).alias("url_lower"))
    index = _index(lower, patterns)
    probes = lower.withColumn("token", F.explode(tokens(F.col("url_lower"))))
    fetched = probes.join(index.filter("token is not null"), "token").select("url", "url_lower", "name", "regex", "allow")
    # Rules without a literal token meet every url; there are only as many as the rule list has.
    loose = [F.struct(F.lit(p.name).alias("name"), F.lit(p.regex).alias("regex"), F.lit(p.allow).alias("allow")) for p in patterns if not p.tokens]
    if loose:
        always = lower.withColumn("rule", F.explode(F.array(*loose))).select("url", "url_lower", "rule.name", "rule.regex", "rule.allow")
        fetched = fetched.unionByName(always)
    hits = fetched.filter(F.regexp_like("url_lower", "regex"))
    best = hits.groupBy("url").agg(F.min(F.struct((~F.col("allow")).alias("blocks"), "name")).alias("best"))
    return best.select("url", F.col("best.name").alias("pattern"), F.when(F.col("best.blocks"), "block").otherwise("allow").alias("verdict"))


def judge(pages: DataFrame, rules=SITE_RULES, patterns=PATTERNS) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``pattern``: one row per row of ``pages``."""
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"))
    rows = rows.withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url")))
    name, verdict = site_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", name).withColumn("ruled", verdict)
    # Rows that a rule decides go around the join; every other url is judged by the patterns, also one without a host.
    undecided = rows.filter("rule is null")
    found = pattern_verdicts(undecided.filter("url is not null").select("url").distinct(), patterns)
    matched = undecided.join(found, "url", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"), "pattern")
    return rows.filter("rule is not null").select(
        "page_id", "host", "path", "rule", F.col("ruled").alias("verdict"), F.lit(None).cast("string").alias("pattern")).unionByName(matched)


def _oracle() -> str:
    ordered = sorted(PATTERNS, key=lambda p: (not p.allow, p.name))
    cases = " ".join(f"WHEN regexp_matches(low, '{p.regex}') THEN '{p.name}'" for p in ordered)
    allowed = ", ".join(f"'{p.name}'" for p in PATTERNS if p.allow)
    return f"""
WITH rules(kind, site, start) AS (VALUES {", ".join(f"('{k}', '{s}', '{p}')" for k, s, p in SITE_RULES)}),
split AS (SELECT page_id, coalesce(url, '') AS url,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
fitting AS (SELECT page_id, site || start AS rule, kind,
    row_number() OVER (PARTITION BY page_id ORDER BY length(site || start) DESC) AS place
    FROM split JOIN rules ON (host = site OR ends_with(host, '.' || site)) AND starts_with(path, start)),
judged AS (SELECT s.*, f.rule, f.kind,
    CASE WHEN f.rule IS NOT NULL THEN NULL ELSE (CASE {cases} END) END AS pattern
    FROM (SELECT *, translate(url, '{UPPER}', '{LOWER}') AS low FROM split) s LEFT JOIN fitting f ON s.page_id = f.page_id AND f.place = 1)
SELECT page_id, host, path, rule,
    coalesce(kind, CASE WHEN pattern IS NULL OR pattern IN ({allowed}) THEN 'allow' ELSE 'block' END) AS verdict, pattern
FROM judged"""


ORACLE = _oracle()
