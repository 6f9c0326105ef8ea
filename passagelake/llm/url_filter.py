"""URL rules by a blocked Bloom filter before an exact hash join.

A rule ``(host, path, verdict)`` fits its host and all subdomains if the url's path
starts with the rule's; the longest rule (host and path together, then the longer
host) wins, and a url without a rule gets ``default``.

Every url is turned into the canonical keys a listed rule could have: each suffix of
its host at a dot, and with it the path cut to each length that listed paths have.
The list's keys set bits in a blocked Bloom filter, a table of 64-bit blocks: one hash
picks the block, four others its bits, so a probe is one equi-join on the block.  Keys
that pass go to an exact join with the rules, which removes false positives.  Hosts are
probed first, so that paths are cut only for hosts that pass.

Urls are folded first: pages that share one url are judged once, so a hot url or host
costs one row, and its verdict returns by a join on the url.  The filter and the rules are
broadcast only if the list has at most ``SMALL_RULES`` rules of at most ``SMALL_BYTES``
bytes; beyond that the same joins shuffle.

Host and path of a null url or one without ``://`` are empty; such urls, and empty
hosts, fit no rule.  Rules with a null part are ignored, of rules with equal host and path
the smallest verdict counts.  Repeated page rows each get their verdict.  An empty list or
table works.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SMALL_RULES = 1 << 17
SMALL_BYTES = 16 << 20
KEYS_PER_BLOCK = 4


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(key, F.lit(blocks))


def _bits(text: Column) -> Column:
    """The bits of a key within its block."""
    own = F.xxhash64(text, F.lit("bits"))
    def bit(i: int) -> Column:
        place = F.shiftrightunsigned(own, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("long"), place)

    return bit(0).bitwiseOR(bit(1)).bitwiseOR(bit(2)).bitwiseOR(bit(3))


def blocked_bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """``(block, word)`` of a table with a text column ``key``."""
    return keys.select(_block(F.xxhash64("key"), blocks).alias("block"), _bits(F.col("key")).alias("bits")).groupBy(
        "block"
    ).agg(F.bit_or("bits").alias("word"))


def _passed(candidates: DataFrame, bloom: DataFrame, blocks: int) -> DataFrame:
    """Candidates whose ``key`` may be in the filter."""
    probed = candidates.select("*", _block(F.xxhash64("key"), blocks).alias("block"), _bits(F.col("key")).alias("bits"))
    hit = probed.join(bloom, "block").where(F.col("word").bitwiseAND(F.col("bits")) == F.col("bits"))
    return hit.drop("block", "bits", "word")


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` of ``pages (page_id, url)``.

    ``rules`` has ``(host, path, verdict)``; ``rule`` is host and path of the winner.
    """
    rules = rules.dropna(subset=["host", "path", "verdict"]).groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    count, size, longest = rules.agg(
        F.count("*"), F.sum(F.octet_length("host") + F.octet_length("path")), F.collect_set(F.char_length("path"))
    ).first()
    small = count <= SMALL_RULES and (size or 0) <= SMALL_BYTES
    sent = F.broadcast if small else (lambda df: df)
    blocks = max(1, 2 * count // KEYS_PER_BLOCK)
    listed = rules.select(F.explode(F.array(F.col("host"), F.concat("host", F.lit("\n"), "path"))).alias("key"))
    bloom = sent(blocked_bloom(listed, blocks))

    urls = pages.select("url").where(F.col("url").isNotNull()).distinct()
    urls = urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    labels = F.split("host", r"\.")
    hosts = urls.where("host <> ''").select(
        "url", "path", F.posexplode(labels).alias("from", "label"), labels.alias("labels")
    ).select("url", "path", F.array_join(F.expr("slice(labels, `from` + 1, size(labels))"), ".").alias("key"))
    hosts = _passed(hosts, bloom, blocks).select("url", "path", F.col("key").alias("rule_host"))
    lengths = F.array(*[F.lit(n) for n in sorted(longest)]).cast("array<int>")
    paths = hosts.select(
        "url", "rule_host", "path", F.explode(F.filter(lengths, lambda n: n <= F.char_length("path"))).alias("n")
    ).select("url", "rule_host", F.expr("left(path, n)").alias("rule_path"))
    paths = paths.withColumn("key", F.concat("rule_host", F.lit("\n"), "rule_path"))
    possible = _passed(paths, bloom, blocks)
    exact = possible.join(
        sent(rules.withColumnsRenamed({"host": "rule_host", "path": "rule_path"})), ["rule_host", "rule_path"]
    )
    rank = F.struct(
        (F.char_length("rule_host") + F.char_length("rule_path")).alias("n"), F.char_length("rule_host").alias("h")
    )
    best = exact.groupBy("url").agg(
        F.max(F.struct(rank, F.concat("rule_host", "rule_path").alias("rule"), "verdict")).alias("best")
    )
    return pages.select("page_id", "url").join(best, "url", "left").select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
