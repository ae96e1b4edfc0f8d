"""URL rules and an exact list of URLs behind a blocked Bloom filter (DataFrame functions only)."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Words of 64 bits in a block; each takes two bits of a key.
WORDS = 4
#: Filters up to this many blocks (40 bytes each) are sent to all executors; larger ones are joined by block.
BROADCAST_BLOCKS = 1 << 18


@dataclass(frozen=True)
class Rule:
    """``verdict`` for the host, its subdomains, and paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty where there is no ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_url(host: Column, path: Column) -> Column:
    """Host and path without a closing ``/`` or ``.html``; scheme, query and fragment do not count."""
    return F.concat(host, F.regexp_replace(path, r"(?:\.html|/)$", ""))


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (name, verdict) of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<name:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):  # the last one set is the longest
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url, F.lit("block")), F.lit(blocks).cast("long"))


def _mask(url: Column, word: int) -> Column:
    """Two bits of the key in one word of its block."""
    bits = F.xxhash64(url, F.lit("bits"))
    one = F.lit(1).cast("long")
    first, second = (F.shiftrightunsigned(bits, 12 * word + 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in (0, 1))
    return F.call_function("shiftleft", one, first).bitwiseOR(F.call_function("shiftleft", one, second))


def build_filter(listed: DataFrame, column: str, bits_per_key: int = 16) -> tuple[DataFrame, int]:
    """Blocked Bloom filter of a column of URLs as a table (block, w0 .. w3), and its number of blocks.

    The number of blocks follows the length of the list, so the rate of false
    positives stays the same at any size. Nulls are left out.
    """
    keys = listed.select(F.col(column).alias("url")).where("url is not null")
    n = keys.count()
    blocks = 1 << max(0, math.ceil(math.log2(max(1, n) * bits_per_key / (64 * WORDS))))
    words = [F.bit_or(_mask(F.col("url"), i)).alias(f"w{i}") for i in range(WORDS)]
    return keys.groupBy(_block(F.col("url"), blocks).alias("block")).agg(*words), blocks


def filter_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url", listed_url: str = "canonical") -> DataFrame:
    """Verdict on every row of ``pages``: the longest rule's, else block if the canonical URL is listed.

    Returns key, host, path, rule, verdict, possible (the Bloom filter's word)
    and listed. The filter passes every listed URL and a few others; those go
    through an exact hash join, so the verdict has no false positives. A URL
    that is null or has no ``://`` has an empty host and path and can't be
    listed. Repeated rows keep their own verdict each; repeated and null
    entries of the list change nothing. Other columns are left behind.
    """
    entries = listed.select(F.col(listed_url).alias("canonical")).where("canonical is not null and canonical <> ''").distinct()
    entries = cut(entries, "listed-urls")  # read for its length, the filter and the exact join
    filter_rows, blocks = build_filter(entries, "canonical")
    parts = pages.select(F.col(key), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    parts = parts.select(key, "host", "path", longest_rule(F.col("host"), F.col("path"), rules).alias("best"), canonical_url(F.col("host"), F.col("path")).alias("canonical"))
    parts = parts.withColumn("block", _block(F.col("canonical"), blocks))
    side = F.broadcast(filter_rows) if blocks <= BROADCAST_BLOCKS else filter_rows
    hit = F.lit(True)
    for i in range(WORDS):
        mask = _mask(F.col("canonical"), i)
        hit = hit & (F.col(f"w{i}").bitwiseAND(mask) == mask)
    probed = parts.join(side, "block", "left").withColumn("possible", F.coalesce(hit, F.lit(False)))
    passed = probed.where("possible").join(entries.withColumn("found", F.lit(True)), "canonical", "left")
    columns = [F.col(key), F.col("host"), F.col("path"), F.col("best"), F.col("possible")]
    together = passed.select(*columns, F.coalesce("found", F.lit(False)).alias("listed")).unionAll(probed.where("not possible").select(*columns, F.lit(False).alias("listed")))
    verdict = F.coalesce(F.col("best.verdict"), F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow")))
    return together.select(F.col(key), "host", "path", F.col("best.name").alias("rule"), verdict.alias("verdict"), "possible", "listed")
