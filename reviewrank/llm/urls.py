"""URL filter: rules by host and path, and a blocked Bloom filter in front of an exact list.

The list of canonical URLs is hashed into a split-block Bloom filter that is itself a table: one row
per block of eight 32-bit lanes, built by one grouped ``bit_or``. A page's URL is tested by a join on
its block, and only possible hits reach the exact hash join, which removes the false positives.
Everything is DataFrame expressions.

Defined cases: a null URL, or one without ``://``, has an empty host and path, fits no rule and is not
listed; an empty list blocks nothing; repeated pages are judged one by one; other columns of the
input are not read, so their names don't matter.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewrank.session import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LANES = 8
LANE_BITS = 32
#: Bits of the filter for each listed URL: about 0.5 % of other URLs pass.
BITS_PER_URL = 12
#: The filter is broadcast up to this size, which is known before the join; beyond it Spark shuffles.
BROADCAST_BYTES = 64 << 20
TRACKING = r"(?:utm_[a-z]+|ref|gclid|fbclid)=[^&]*"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def canonical(url: Column) -> Column:
    """Host without ``www.``, path without closing slashes, query without tracking; no fragment.

    Null where the URL has no host.
    """
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(query, rf"(?:^|&){TRACKING}(?=&|$)", "")
    query = F.regexp_replace(query, r"^&", "")
    return F.when(host != "", F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null where none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):  # a later, longer rule wins
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        text, verdict = F.when(fits, rule.text).otherwise(text), F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), key), F.lit(blocks))


def _mask(key: Column, lane: int) -> Column:
    """One bit of a lane, as a long."""
    bit = F.pmod(F.xxhash64(F.lit(lane), key), F.lit(LANE_BITS)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)


def bloom_blocks(listed: DataFrame, column: str, blocks: int) -> DataFrame:
    """The filter: ``block`` and eight lanes of 32 bits, for the blocks that hold anything."""
    key = F.col(column)
    return listed.groupBy(_block(key, blocks).alias("block")).agg(
        *(F.bit_or(_mask(key, i)).alias(f"lane{i}") for i in range(LANES))
    )


def may_be_listed(urls: DataFrame, column: str, listed: DataFrame, listed_column: str) -> DataFrame:
    """``urls`` with ``possible``: false only where the value is surely not listed."""
    size = listed.count()
    blocks = max(1, -(-size * BITS_PER_URL // (LANES * LANE_BITS)))
    table = written(bloom_blocks(listed, listed_column, blocks), "bloom")
    if blocks * LANES * 8 <= BROADCAST_BYTES:
        table = F.broadcast(table)
    key = F.col(column)
    probed = urls.withColumn("block", _block(key, blocks)).join(table, "block", "left")
    hit = F.lit(True)
    for i in range(LANES):
        hit = hit & (F.col(f"lane{i}").bitwiseAND(_mask(key, i)) != 0)
    possible = F.coalesce(hit & key.isNotNull(), F.lit(False))
    return probed.withColumn("possible", possible).drop("block", *(f"lane{i}" for i in range(LANES)))


def judge_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``page_id, host, path, rule, verdict, canonical_url, possible, listed`` for every page.

    ``listed`` has one column ``url`` of listed URLs in any spelling.
    """
    exact = written(
        listed.select(canonical(F.col("url")).alias("listed_url")).where("listed_url is not null").distinct(),
        "listed-urls",
    )
    url = F.col("url")
    cut = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("canonical_url"))
    cut = cut.withColumns({c: F.coalesce(c, F.lit("")) for c in ("host", "path")})
    tested = written(may_be_listed(cut, "canonical_url", exact, "listed_url"), "tested-urls")
    sure = tested.where(~F.col("possible")).withColumn("listed", F.lit(False))
    checked = (
        tested.where("possible")
        .join(exact, F.col("canonical_url") == F.col("listed_url"), "left")
        .withColumn("listed", F.col("listed_url").isNotNull())
        .drop("listed_url")
    )
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)
    by_list = F.when(F.col("listed"), "block").otherwise("allow")
    return sure.unionByName(checked).select(
        "page_id", "host", "path", text.alias("rule"), F.coalesce(verdict, by_list).alias("verdict"), "canonical_url", "possible", "listed"
    )
