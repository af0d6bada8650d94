"""URL verdicts: host and path rules, then an exact list behind a blocked Bloom filter.

The filter is a table: one row per block, eight 64-bit words each. A listed URL sets one bit
in every word of the one block its hash names, so a probe reads one row. URLs that pass go to
an exact join with the list, which removes the false positives; a listed URL always passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import lookup, total
from orderlens.session import staged

# (action, host, path prefix); a rule fits its host and all subdomains, the longest one wins.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
WORDS = 8
KEYS_PER_BLOCK = 32  # 16 bits a key: about one false hit in a thousand
# A filter of more blocks (72 bytes each) is joined by shuffle instead of broadcast.
BROADCAST_BLOCKS = 2 ** 17
LETTERS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), *LETTERS)


def path_of(url: Column) -> Column:
    """After the host, up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, nulls where none fits."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for action, domain, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(prefix)
        out = F.when(fits, F.struct(F.lit(domain + prefix).alias("rule"),
                                    F.lit(action).alias("verdict"))).otherwise(out)
    return out


def canonical(host: Column, path: Column) -> Column:
    """Host without ``www.`` or ``m.``, path without ``.html`` and slashes at its end; scheme,
    query and fragment are gone. Null without a host."""
    return F.when(host != "", F.concat(
        F.regexp_replace(host, r"^(www|m)\.", ""),
        F.regexp_replace(path, r"(\.html)?/*$", "")))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _masks(key: Column) -> list[Column]:
    """One bit per word, six bits of a second hash each."""
    second = F.xxhash64(key, F.lit(1))
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(
        second, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(WORDS)]


def bloom_filter(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """Rows (block, w0..w7) of a blocked Bloom filter of non-null keys."""
    bits = listed.select(_block(F.col(key), blocks).alias("block"), *[
        m.alias(f"w{i}") for i, m in enumerate(_masks(F.col(key)))])
    return bits.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def possible_hits(urls: DataFrame, listed: DataFrame, key: str, n_listed: int) -> DataFrame:
    """Rows of ``urls`` whose key the filter of ``listed`` lets through."""
    blocks = max(1, -(-n_listed // KEYS_PER_BLOCK))
    bloom = bloom_filter(listed, key, blocks)
    if blocks <= BROADCAST_BLOCKS:
        bloom = F.broadcast(bloom)
    probe = urls.withColumn("block", _block(F.col(key), blocks))
    masks = [F.col(f"w{i}").bitwiseAND(m) == m for i, m in enumerate(_masks(F.col(key)))]
    hit = total([m.cast("int") for m in masks]) == WORDS
    return probe.join(bloom, "block").where(hit).select(*urls.columns)


def judge(pages: DataFrame, listed: DataFrame, url: str = "url", page: str = "page_id",
          rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """Host, path, rule and verdict of every page; ``listed`` has a column ``key`` of
    canonical URLs, repeats and nulls allowed.

    A fitting rule decides. Else a page is blocked if its canonical URL is listed, and allowed
    if not. A null url, or one without ``://``, has an empty host and path and is allowed.
    Each distinct canonical URL is probed and joined once, however many pages carry it.
    """
    host, path = host_of(F.col(url)), path_of(F.col(url))
    named = staged(pages.select(F.col(page).alias("page_id"), host.alias("host"), path.alias("path"))
                   .withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
                   .withColumn("key", canonical(F.col("host"), F.col("path"))))
    listed = staged(listed.select("key").where(F.col("key").isNotNull()).distinct())
    open_urls = (named.where(F.col("_rule").isNull() & F.col("key").isNotNull())
                 .groupBy("key").agg(F.count("*").alias("_n")))
    passed = possible_hits(open_urls, listed, "key", listed.count())
    blocked = staged(passed.join(listed, "key").withColumn("listed", F.lit(True)))
    found = lookup(named.withColumn("key", F.when(F.col("_rule").isNull(), F.col("key"))),
                   blocked, ["key"], "_n")
    return found.select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", F.when(F.col("listed"), "block").otherwise("allow"))
        .alias("verdict"), F.coalesce("listed", F.lit(False)).alias("listed"))
