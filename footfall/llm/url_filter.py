"""URL filter: rules first, then a list of URLs behind a blocked Bloom filter."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.exchange import hidden, others, shown

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"

#: One block is one 64-bit word, so a probe reads one row.  With so many keys a block and bits a key,
#: some 40 per cent of the bits are set and 2 to 3 per cent of other URLs pass as possible hits.
KEYS_PER_BLOCK, BITS_PER_KEY = 8, 4
LEAST_BLOCKS = 1 << 10
#: A filter of up to so many rows of two numbers (some 16 MB, for 8 million URLs) is broadcast; a larger
#: one is joined by block.
BROADCAST_BLOCKS = 1 << 20

Rule = tuple[str, str, str]


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, URL_PARTS, 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, URL_PARTS, 2), F.lit(""))


def canonical_url(host: Column, path: Column) -> Column:
    """Host without a leading ``www.`` or ``m.``, path without slashes at its end."""
    return F.concat(F.regexp_replace(host, r"^(?:www|m)\.", ""), F.rtrim(path, F.lit("/")))


def first_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest fitting rule as a struct of ``rule`` and ``verdict``, else NULL.

    A rule ``(verdict, host, path)`` fits its host and all subdomains where the path starts with
    the rule's.  Rules are the caller's short policy list; among rules of one length the one
    with the longer host wins, then ``block``.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block", r))
    fitting = [
        F.when(
            ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path),
            F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict")),
        )
        for verdict, rule_host, rule_path in ordered
    ]
    return F.coalesce(*fitting) if fitting else F.lit(None).cast("struct<rule:string,verdict:string>")


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _bits(key: Column) -> Column:
    """The bits of a key within its block, from a hash that the block does not depend on."""
    hashed = F.xxhash64(F.lit("bits"), key)
    bits = [
        F.call_function("shiftleft", F.lit(1).cast("long"),
                        F.pmod(F.shiftright(hashed, 6 * i), F.lit(64)).cast("int"))
        for i in range(BITS_PER_KEY)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def blocks_for(n_keys: int) -> int:
    """A power of two of blocks that hold about ``KEYS_PER_BLOCK`` keys each."""
    return max(LEAST_BLOCKS, 1 << (max(1, -(-n_keys // KEYS_PER_BLOCK)) - 1).bit_length())


def blocked_bloom(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """A blocked Bloom filter of a column: columns ``block`` and ``word``, at most ``blocks`` rows.

    ``bit_or`` is associative, so each task merges its keys before the shuffle and sends no more
    than ``blocks`` rows.
    """
    return (
        keys.where(F.col(key).isNotNull())
        .groupBy(_block(F.col(key), blocks).alias("block"))
        .agg(F.bit_or(_bits(F.col(key))).alias("word"))
    )


def url_verdicts(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule],
                 url: str = "url", listed_url: str = "url", blocks: int | None = None,
                 broadcast_blocks: int = BROADCAST_BLOCKS) -> DataFrame:
    """Judge every row of ``pages``; its columns stay, and five follow.

    ``host`` and ``path`` are the parts of the URL, ``rule`` the longest fitting rule (else NULL),
    ``listed`` whether the canonical URL is one of ``listed``, and ``verdict`` the rule's, else
    ``block`` for a listed URL and ``allow`` for any other.

    The filter of the listed canonical URLs has as many ``blocks`` as their number asks for, and is
    broadcast up to ``broadcast_blocks`` of them; beyond, rows meet it in a shuffled join by block,
    rows without a host dealt evenly.  Rows that it lets through are possible hits; only their distinct URLs meet the list in an
    exact hash join, which removes false positives, and the confirmed ones come back to those
    rows.  A URL that a third of all rows share is one row of that join.  With a broadcast filter all
    other rows are never shuffled.

    A NULL URL, or one without ``://``, has empty parts, fits no rule and is never listed.
    Repeated rows are judged alike; columns of ``pages`` named like a result column are replaced.
    """
    kept = others(pages.columns, ("host", "path", "rule", "listed", "verdict"))
    parts = (
        pages.select(*hidden(kept), url_host(F.col(url)).alias("host"),
                     url_path(F.col(url)).alias("path"))
        .withColumn("_rule", first_rule(F.col("host"), F.col("path"), rules))
        .withColumn("_key", F.when(F.col("host") != "", canonical_url(F.col("host"), F.col("path"))))
    )
    keys = (
        listed.select(url_host(F.col(listed_url)).alias("h"), url_path(F.col(listed_url)).alias("p"))
        .where(F.col("h") != "").select(canonical_url(F.col("h"), F.col("p")).alias("_listed"))
    )
    if blocks is None:
        blocks = blocks_for(keys.distinct().count())
    bloom = blocked_bloom(keys, "_listed", blocks).select("block", F.col("word").alias("_word"))
    none = F.lit(-1) - F.pmod(F.monotonically_increasing_id(), F.lit(1 << 16)).cast("int")
    parts = parts.withColumn("_block", F.coalesce(_block(F.col("_key"), blocks), none))
    small = blocks <= broadcast_blocks
    probed = (
        parts.join(F.broadcast(bloom) if small else bloom.hint("merge"), F.col("_block") == F.col("block"), "left")
        .withColumn("_possible", F.coalesce(
            F.col("_word").bitwiseAND(_bits(F.col("_key"))) == _bits(F.col("_key")), F.lit(False)))
        .withColumn("_probe", F.when(F.col("_possible"), F.col("_key")))
        .drop("_block", "block", "_word", "_key")
    )
    maybe = probed.where(F.col("_probe").isNotNull())
    confirmed = (
        maybe.select(F.col("_probe").alias("_hit")).distinct()
        .join(keys.distinct().hint("shuffle_hash"), F.col("_hit") == F.col("_listed"), "left_semi")
    )
    hits = (
        maybe.join(confirmed, F.col("_probe") == F.col("_hit"), "left")
        .withColumn("_on", F.col("_hit").isNotNull()).drop("_hit")
        .unionByName(probed.where(F.col("_probe").isNull()).withColumn("_on", F.lit(False)))
    )
    return hits.select(
        *shown(kept), "host", "path", F.col("_rule.rule").alias("rule"), F.col("_on").alias("listed"),
        F.coalesce(F.col("_rule.verdict"),
                   F.when(F.col("_on"), "block").otherwise("allow")).alias("verdict"),
    )
