"""URL filters: a blocked Bloom filter before an exact hash join.

Entries are canonical URLs, a host and the start of a path. A URL's host and
parent domains are looked up first; those that entries have are looked up with
the path's starts of the lengths that this host's entries have. The filter is a
table of blocks of eight 64-bit words; a key sets one bit in each word of one
block. Lookups whose bits are all set go on to the exact join, which removes the
false positives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .workspace import Workspace, bounded, hot_join

#: Bits of the filter per entry, and blocks (64 bytes each) at most: a broadcast of 16 MB. Beyond it there are more false positives, not fewer hits.
BITS_PER_KEY, MAX_BLOCKS = 16, 262_144
#: Rows of entries or of found URLs (as digests) that are broadcast at most.
BROADCAST_ROWS = 200_000
WORDS = 8
#: Stands for a path in the filter's keys of hosts alone; no path of a URL begins so.
ANY_PATH = "*"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and where there is no ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _block(host: Column, path: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(host, path), F.lit(blocks))


def _bits(host: Column, path: Column) -> list[Column]:
    mark = F.xxhash64(F.lit(1), host, path)
    return [F.expr(f"shiftleft(1L, cast(shiftrightunsigned(__mark, {6 * k}) & 63 AS int))") for k in range(WORDS)], mark


class BlockedBloom:
    """The filter of a table with columns host and path, as a table of blocks."""

    def __init__(self, entries: DataFrame, count: int, work: Workspace):
        self.blocks = max(1, min(MAX_BLOCKS, -(-count * BITS_PER_KEY // (64 * WORDS))))
        bits, mark = _bits(F.col("host"), F.col("path"))
        keyed = entries.select(_block(F.col("host"), F.col("path"), self.blocks).alias("block"), mark.alias("__mark"))
        self.table = work.save(keyed.groupBy("block").agg(*[F.bit_or(b).alias(f"w{k}") for k, b in enumerate(bits)]), "bloom")

    def possible(self, lookups: DataFrame) -> DataFrame:
        """The rows of lookups (host, path) whose bits are all set."""
        bits, mark = _bits(F.col("host"), F.col("path"))
        keyed = lookups.withColumn("block", _block(F.col("host"), F.col("path"), self.blocks)).withColumn("__mark", mark)
        met = keyed.join(F.broadcast(self.table), "block")
        for k, b in enumerate(bits):
            met = met.where(F.col(f"w{k}").bitwiseAND(b) != 0)
        return met.select(lookups.columns)


def _exact(lookups: DataFrame, listed: DataFrame, key: list[str], count: int, work: Workspace, name: str) -> DataFrame:
    """lookups joined with the ``count`` rows of listed; of a long list only what some lookup has, and no frequent key is one task's work."""
    if count <= BROADCAST_ROWS:
        return lookups.join(F.broadcast(listed), key)
    lookups = work.save(lookups, f"{name}-lookups")
    met = work.save(lookups.groupBy(*key).agg(F.count("*").alias("__times")).join(listed, key), f"{name}-met")
    total = lookups.count()
    # Facts of one key must be one row.
    facts = met.groupBy(*key).agg(F.max("__times").alias("__times"), F.collect_list(F.struct(*[c for c in listed.columns if c not in key])).alias("__facts"))
    return hot_join(lookups, facts, key, "__times", total).withColumn("__fact", F.explode("__facts")).select(*lookups.columns, "__fact.*")


def judge(pages: DataFrame, rules: DataFrame, listed: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of pages: id, host, path, rule, verdict.

    rules has host, path and verdict; a rule fits its host and all subdomains
    where the URL's path starts with the rule's, and the longest fitting rule
    (host and path together) wins. listed has host and path of blocked URLs
    that hold in the same way where no rule fits. Anything else is allowed.
    rule is the rule's host and path, null where none fits. Of rules with equal
    host and path the smallest verdict counts. Null URLs and those without ://
    have an empty host and path and are allowed; repeated rows and null ids are
    kept; other columns are ignored. Empty tables give an empty result or no
    rule.

    Distinct URLs are looked up and go by their digests. What was found is handed back to the rows by a
    broadcast if it is small, else by a shuffle but for frequent URLs (see hot_join).
    """
    work = Workspace(pages.sparkSession, "urls")
    own = rules.select("host", "path", "verdict", F.lit(True).alias("is_rule"))
    if listed is not None:
        own = own.unionByName(listed.select("host", "path", F.lit("block").alias("verdict"), F.lit(False).alias("is_rule")))
    entries = own.where("host IS NOT NULL AND path IS NOT NULL").groupBy("host", "path", "is_rule").agg(F.min("verdict").alias("verdict"))
    entries = work.save(entries, "entries")
    spans = work.save(entries.groupBy("host").agg(F.collect_set(F.length("path")).alias("lengths"), F.count("*").alias("entries")), "hosts")
    facts = spans.agg(F.sum("entries").alias("n"), F.count("*").alias("hosts"), F.max(F.size(F.split("host", r"\."))).alias("labels")).first()
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    if not facts["n"]:
        return rows.select(F.col("id").alias(id_col), host.alias("host"), path.alias("path"), F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))

    keys = entries.select("host", "path").distinct().unionByName(spans.select("host", F.lit(ANY_PATH).alias("path")))
    bloom = BlockedBloom(keys, facts["n"] + facts["hosts"], work)
    rows = rows.withColumn("digest", F.unhex(F.sha2("url", 256)))
    urls = rows.select("url", "digest").where("url IS NOT NULL").groupBy("url", "digest").agg(F.count("*").alias("n")).select("digest", "n", host.alias("whole_host"), path.alias("whole_path"))
    labels = F.split("whole_host", r"\.")
    count = F.size(labels)
    hosts = F.transform(F.sequence(F.greatest(F.lit(1), count - facts["labels"] + 1), count), lambda i: F.array_join(F.slice(F.split("whole_host", r"\."), i, 10_000_000), "."))
    found = bloom.possible(urls.select("digest", "n", "whole_path", F.explode(hosts).alias("host"), F.lit(ANY_PATH).alias("path")))
    found = _exact(found.drop("path"), spans.select("host", "lengths"), ["host"], facts["hosts"], work, "hosts")
    lengths = F.filter("lengths", lambda n: n <= F.length("whole_path"))
    starts = found.select("digest", "n", "host", "whole_path", F.explode(lengths).alias("length"))
    maybe = bloom.possible(starts.select("digest", "n", "host", F.expr("substring(whole_path, 1, length)").alias("path")))
    hits = _exact(maybe, entries, ["host", "path"], facts["n"], work, "entries")
    rank = F.struct("is_rule", (F.length("host") + F.length("path")).alias("length"), F.concat("host", "path").alias("rule"), "verdict")
    best = work.save(hits.groupBy("digest").agg(F.max(rank).alias("best"), F.max("n").alias("n")).select("digest", "n", "best.*"), "best")
    best = best.select("digest", "n", F.when(F.col("is_rule"), F.col("rule")).alias("rule"), "verdict")
    small = bounded(best, BROADCAST_ROWS)
    if small is best:
        told = hot_join(rows, best, ["digest"], "n", rows.count(), "left")
    else:
        told = rows.join(small, "digest", "left")
    return told.select(F.col("id").alias(id_col), host.alias("host"), path.alias("path"), "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"))
