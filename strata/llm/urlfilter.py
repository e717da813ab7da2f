"""URL filter: host and path rules over an exact Bloom filter cascade.

The cascade tells whether a key is listed, for every key of a known universe.
Level 1 is a Bloom filter of the listed keys; level 2 holds the other keys that
level 1 lets through, level 3 the listed keys that level 2 lets through, and so
on until a level lets none through. A key is listed if the first level that
refuses it is an even one, or if none refuses it and the last level is odd.

Filters are arrays of 64-bit words, built with ``bit_or`` and placed in the
query as constants, so looking up a key is an expression, not a join. Their
size follows the number of listed keys. Above ``max_filter_bits`` (2 MB) no
filter is built and the listed keys are joined by hash instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.bloom import bloom_filter
from strata.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_FILTER_BITS = 1 << 24
BITS_PER_KEY = 10


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null where there is none."""
    before = F.when(F.contains(url, F.lit("://")), F.substring_index(url, "://", 1))
    return F.substr(url, F.char_length(before) + 4)


def host(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z in lower
    case; empty without ``://`` and for null."""
    name = F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(name, UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty like the host."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def domains(name: Column) -> Column:
    """A host name and its parent domains, longest first."""
    parts = F.split(name, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)),
                       lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def cascade(universe: DataFrame, listed: DataFrame, max_filter_bits: int = MAX_FILTER_BITS
            ) -> Callable[[Column], Column] | None:
    """Exact membership test for the keys of ``universe`` (column ``key``) in
    ``listed`` (same), or None where the filters would outgrow the bound.

    Null keys are in neither. Without listed keys nothing is a member.
    """
    marked = materialize(
        universe.where("key is not null").distinct()
        .join(listed.where("key is not null").distinct().withColumn("listed", F.lit(True)), "key", "left")
        .select("key", F.coalesce("listed", F.lit(False)).alias("listed")), "universe")
    tests: list[Callable[[Column], Column]] = []
    inside, outside = marked.where("listed"), marked.where("not listed")
    while n := inside.count():
        bits = 64 * -(-n * BITS_PER_KEY // 64)
        if bits > max_filter_bits:
            return None
        level = len(tests)
        tests.append(bloom_filter(inside, bits, salt=level))
        inside, outside = materialize(outside.where(tests[-1](F.col("key"))), f"passed-{level}"), inside

    def member(key: Column) -> Column:
        result = F.lit(len(tests) % 2 == 1)     # let through by every level
        for level in reversed(range(len(tests))):
            result = F.when(tests[level](key), result).otherwise(F.lit(level % 2 == 1))
        return result
    return member


def rule(host: Column, path: Column, rules: list[tuple[str, str, str]], field: int) -> Column:
    """Of the longest rule that fits, its text (``field`` 1) or verdict (0), else
    null. ``rules``: (verdict, host, path). A rule fits its host and every
    subdomain where the path starts with its own."""
    choice = F.lit(None).cast("string")
    for verdict, name, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        choice = F.when(fits, F.lit((verdict, name + start)[field])).otherwise(choice)
    return choice


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], blocklist: DataFrame, url_col: str = "url",
          max_filter_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` added (columns
    of those names are replaced). Where no rule fits, a page is blocked if its
    host or a parent domain is in ``blocklist`` (column ``domain``).

    A null url, or one without ``://``, has an empty host and path and is
    allowed. Repeated rows stay repeated; an empty table gives no rows.
    """
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    row = F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.struct(F.lit(0).alias("none"))
    found = pages.select(row.alias("row"), host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path"))    # no name can clash
    keys = pages.select(host(F.col(url_col)).alias("host")).distinct().select(F.explode(domains(F.col("host"))).alias("key"))
    listed = blocklist.select(F.translate("domain", UPPER, LOWER).alias("key"))
    member = cascade(keys, listed, max_filter_bits)
    if member is None:
        hit = (keys.distinct().join(listed.distinct(), "key", "left_semi"))
        hosts = found.select("host").distinct().select(F.col("host").alias("bad_host"), F.explode(domains(F.col("host"))).alias("key"))
        bad = materialize(hosts.join(hit, "key", "left_semi").select("bad_host").distinct(), "blocked-hosts")
        found = found.join(bad, found["host"] == bad["bad_host"], "left").withColumn("listed", F.col("bad_host").isNotNull())
    else:
        found = found.withColumn("listed", F.exists(domains(F.col("host")), member))
    h, p = F.col("host"), F.col("path")
    verdict = F.coalesce(rule(h, p, rules, 0), F.when(F.col("listed"), "block").otherwise("allow"))
    return found.select(*[F.col("row").getField(c).alias(c) for c in kept], "host", "path", rule(h, p, rules, 1).alias("rule"), verdict.alias("verdict"))
