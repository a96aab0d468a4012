"""URL filters: rules by host and path, then a list of canonical URLs.

The list is checked in two steps. A blocked Bloom filter of the listed URLs, small enough
to be broadcast whatever the list's size, lets most unlisted URLs through at once; those it
may hold are joined with the list itself, which removes its false positives. Everything is
a built-in expression.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Blocks of the filter: 2**14 rows of 8 words are 1 MiB, the bound of what is broadcast.
#: A longer list makes it let fewer URLs through early; results stay the same.
BLOCKS = 1 << 14
WORDS = 8


@dataclass(frozen=True)
class Rule:
    """``verdict`` for ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?`` or ``#``, A-Z lower-cased; or empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; or empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    """The form in which URLs are listed: no scheme, no leading ``www.``, no slash at the end."""
    return F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, "/+$", ""))


def _by_rule(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, NULL without one."""
    name, verdict = F, F
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = name.when(fits, rule.name)
        verdict = verdict.when(fits, rule.verdict)
    if not rules:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return name.otherwise(F.lit(None)), verdict.otherwise(F.lit(None))


def _block(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BLOCKS)).cast("int")


def _bit(key: Column, word: int) -> Column:
    """The bit of ``key`` in one word of its block: six bits of a second hash."""
    place = F.shiftrightunsigned(F.xxhash64(key, F.lit(7)), 6 * word).bitwiseAND(F.lit(63))
    return F.call_function(
        "shiftleft", F.lit(1).cast("long"), place.cast("int")
    )


def bloom_filter(keys: DataFrame, key: str) -> DataFrame:
    """(block, w0 .. w7): every key sets one bit in each word of its block."""
    k = F.col(key)
    bits = keys.select(_block(k).alias("block"), *[_bit(k, i).alias(f"w{i}") for i in range(WORDS)])
    return bits.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def judge(df: DataFrame, rules: list[Rule], listed: DataFrame, url_column: str = "url") -> DataFrame:
    """``df`` plus ``host``, ``path``, ``rule`` and ``verdict`` (allow or block).

    The longest fitting rule decides; rules are a short list given in the plan, with upper
    bound 1,000. Where none fits, URLs in ``listed`` (its first column, in the form of
    ``canonical``) are blocked and others allowed.

    A NULL URL, or one without ``://``, has an empty host and path and is allowed. Repeated
    rows are judged each; URLs of any length are judged whole; NULLs and repeats in ``listed``
    do nothing; empty tables give empty results. Columns of ``df`` by the four names are
    replaced, others stay, whatever their names.
    """
    if len(rules) > 1000:
        raise ValueError("more than 1,000 rules belong in the list")
    df = df.drop("host", "path", "rule", "verdict")
    # The caller's columns travel as one, so that none can be mistaken for one of these.
    row = F.struct(*[df[f"`{c}`"] for c in df.columns])
    packed = df.select(row.alias("row"), df[f"`{url_column}`"].alias("url"))
    split = packed.select("row", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = _by_rule(rules, F.col("host"), F.col("path"))
    ruled = split.withColumns({"rule": rule, "verdict": verdict})
    key = F.when(F.col("rule").isNull(), canonical(F.col("host"), F.col("path")))
    ruled = ruled.withColumn("key", key)

    names = listed.select(F.col(listed.columns[0]).alias("listed")).where("listed IS NOT NULL")
    blocks = bloom_filter(names, "listed")
    probed = ruled.withColumn("block", _block(F.col("key"))).join(F.broadcast(blocks), "block", "left")
    maybe = F.lit(True)
    for i in range(WORDS):
        maybe = maybe & (F.col(f"w{i}").bitwiseAND(_bit(F.col("key"), i)) != 0)
    probed = probed.withColumn("maybe", F.coalesce(F.col("key").isNotNull() & maybe, F.lit(False)))
    out = ["row.*", "host", "path", "rule"]
    clear = probed.where(~F.col("maybe")).select(*out, F.coalesce("verdict", F.lit("allow")).alias("verdict"))
    hits = probed.where("maybe").join(names.distinct(), F.col("key") == F.col("listed"), "left")
    exact = F.when(F.col("listed").isNotNull(), "block").otherwise("allow")
    return clear.union(hits.select(*out, exact.alias("verdict")))
