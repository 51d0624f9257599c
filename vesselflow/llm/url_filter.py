"""URL filters: a blocked Bloom filter of listed canonical URLs in front of an exact hash join.

Both the filter and the exact list are ordinary tables. A filter row is one 256-bit block (four longs); a listed URL
sets two bits in each long of the one block its hash selects, `bit_or` builds the blocks, and a page joins the single
block of its own URL. Only pages that pass reach the exact join, which removes the false positives. Every join is on a
hash or a URL, so Spark broadcasts a side only when its known size is under the session's threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vesselflow.llm import _common as C

#: (verdict, host, path); a rule fits its host and all subdomains where the path starts with its own.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

#: Stand-in for a published list of unwanted URLs: all URLs met on these sites.
UNWANTED_SITES = ("ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BITS_PER_URL = 16


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): host lower-cased in A-Z; null or no `://` gives two empty strings."""
    tail = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(tail, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(tail, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def canonical(host: Column, path: Column) -> Column:
    """Key of a URL: host without `www.` or `m.`, path without trailing slashes and `.html`; '' where there is no host."""
    key = F.concat(F.regexp_replace(host, r"^(www|m)\.", ""), F.regexp_replace(F.regexp_replace(path, r"/+$", ""), r"\.html$", ""))
    return F.when(host == "", F.lit("")).otherwise(key)


def rule_columns(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. `rules` is a short list given by the caller."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, at, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(start)
        rule = F.when(fits, F.lit(at + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _bits(h: Column, word: int) -> Column:
    """Two of the 64 bits of one long of a block."""
    one = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), k)
    a = F.pmod(F.shiftrightunsigned(h, 12 * word), F.lit(64)).cast("int")
    b = F.pmod(F.shiftrightunsigned(h, 12 * word + 6), F.lit(64)).cast("int")
    return one(a).bitwiseOR(one(b))


def bloom_blocks(keys: DataFrame, n_blocks: int) -> DataFrame:
    """One row per block in use: block, w0..w3."""
    h = F.xxhash64(F.lit(1), F.col("key"))
    return (
        keys.select(F.pmod(F.xxhash64("key"), F.lit(n_blocks)).alias("block"), *(_bits(h, i).alias(f"w{i}") for i in range(4)))
        .groupBy("block")
        .agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4)))
    )


def filter_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, url: str = "url") -> DataFrame:
    """`pages` with host, path, rule and verdict added (columns of those names are replaced).

    listed: a DataFrame with a column `url`; its canonical URLs are blocked unless a rule decides. Null or host-less
    URLs never match the list. Repeated rows are judged each; an empty list or table gives the plain result.
    """
    host, path = split_url(F.col("_page")[url])
    lhost, lpath = split_url(F.col("url"))
    keys = C.stage(listed.select(canonical(lhost, lpath).alias("key")).where("key <> ''").distinct())
    n_blocks = max(1, -(-keys.count() * BITS_PER_URL // 256))
    blocks = C.stage(bloom_blocks(keys, n_blocks))

    # `inline` keeps Spark from copying the parsing into every condition that mentions host or path.
    # The other columns are held in one, so that none clashes with those made here.
    mine = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    out = pages.select(F.struct(*(F.col(f"`{c}`") for c in mine)).alias("_page"))
    out = out.select("*", F.inline(F.array(F.struct(host.alias("host"), path.alias("path")))))
    rule, kind = rule_columns(F.col("host"), F.col("path"), rules)
    # A page that a rule decides, or without a host, needs no look at the list. Its key is no URL but a space and the
    # page's number, so that these pages don't meet in one task of the last join.
    listable = rule.isNull() & (F.col("host") != "")
    out = out.withColumn("_n", F.monotonically_increasing_id())
    key = F.when(listable, canonical(F.col("host"), F.col("path"))).otherwise(F.concat(F.lit(" "), F.col("_n").cast("string")))
    out = out.select("*", F.inline(F.array(F.struct(rule.alias("rule"), kind.alias("_kind"), key.alias("_key")))))

    asked = out.where(F.col("rule").isNull() & (F.col("host") != "")).select(F.col("_key").alias("key")).distinct()
    h = F.xxhash64(F.lit(1), F.col("key"))
    asked = asked.select("key", F.pmod(F.xxhash64("key"), F.lit(n_blocks)).alias("block"), *(_bits(h, i).alias(f"m{i}") for i in range(4)))
    passes = F.lit(True)
    for i in range(4):
        passes = passes & (F.col(f"w{i}").bitwiseAND(F.col(f"m{i}")) == F.col(f"m{i}"))
    possible = asked.join(blocks, "block").where(passes).select("key")
    hits = possible.join(keys, "key", "left_semi").select(F.col("key").alias("_key"), F.lit(True).alias("_hit"))
    out = out.join(hits, "_key", "left")
    found = F.coalesce(F.col("_hit"), F.lit(False))
    verdict = F.coalesce(F.col("_kind"), F.when(found, F.lit("block")).otherwise(F.lit("allow")))
    return out.select(*(F.col("_page")[c].alias(c) for c in mine), "host", "path", "rule", verdict.alias("verdict"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = C.table(spark, sf_dir, "pages").select("page_id", "url")
    host, _ = split_url(F.col("url"))
    site = F.array_intersect(F.split(host, r"\."), F.array(*map(F.lit, UNWANTED_SITES)))
    listed = pages.where(F.size(site) > 0).select("url")
    return filter_urls(pages, listed).select("page_id", "host", "path", "rule", "verdict")


SQL = {
    "op10_url_filter": r"""
WITH t AS (SELECT page_id, coalesce(regexp_extract(url, '^.*?://(.*)$', 1, 's'), '') AS tail FROM pages),
p AS (SELECT page_id, translate(regexp_extract(tail, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) AS path FROM t),
k AS (SELECT *, CASE WHEN host = '' THEN '' ELSE regexp_replace(host, '^(www|m)\.', '') || regexp_replace(regexp_replace(path, '/+$', ''), '\.html$', '') END AS key,
  CASE WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
       WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
       WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
       WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
       WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule FROM p),
listed AS (SELECT DISTINCT key FROM k WHERE key <> '' AND list_has_any(string_split(host, '.'), ['ads-track','casino-win','cheap-pills','free-bets','spam-farm']))
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN key IN (SELECT key FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM k"""
}
