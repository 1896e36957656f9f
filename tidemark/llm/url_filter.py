"""URL rules matched by hashed host-suffix and path-prefix expressions.

A rule is a host and the start of a path.  Every URL is expanded into the
expressions a rule could have: suffixes of the host and prefixes of the path.
Expressions and rules meet by an equi-join on the first hex digits of their
SHA-256; a met pair counts only if the whole digests agree.  Of the rules that
fit, the longest (host and path) decides, ``block`` before ``allow`` at equal
length.  Only as many labels and prefix lengths are expanded as some rule has,
so a URL gives at most (label counts x path lengths) expressions, however long
it is, and no rule is missed.

Each distinct URL is judged once and the verdicts are joined back, so a URL or
host that fills a third of the table costs no more than another.

Defined results: a null URL, or one without ``://``, has an empty host and
path; a rule on the empty host fits nothing; without a fitting rule the verdict
is ``default``; repeated rows get the same verdict; columns of the input that
carry the names of results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, small

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hex digits of the digest that pairs are joined by.
PREFIX = 8
_RULES_TO_BROADCAST = 100_000


def host(url: Column) -> Column:
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(after, UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def judge_urls(
    pages: DataFrame, rules: DataFrame, column: str = "url", default: str = "allow"
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``.

    ``rules`` has the columns ``host``, ``path`` and ``verdict``.
    """
    known = cut(
        rules.filter("host <> ''")
        .select(
            F.concat("host", F.coalesce("path", F.lit(""))).alias("__rule"),
            "verdict",
            F.sha2(F.concat_ws("\n", "host", F.coalesce("path", F.lit(""))), 256).alias("__digest"),
            F.size(F.split("host", r"\.")).alias("labels"),
            F.length(F.coalesce("path", F.lit(""))).alias("length"),
        )
        .groupBy("__rule", "__digest", "labels", "length")
        .agg(F.max("verdict").alias("verdict"))  # block before allow
        .withColumn("__prefix", F.substring("__digest", 1, PREFIX))
    )
    shapes = known.agg(F.collect_set("labels"), F.collect_set("length")).first()
    labels, lengths = (sorted(s) for s in shapes)
    parts = pages.select(
        F.col(f"`{column}`").alias("__url"), host(F.col(f"`{column}`")).alias("__host"), path(F.col(f"`{column}`")).alias("__path")
    )
    urls = parts.filter("__host <> ''").groupBy("__url").agg(F.first("__host").alias("__host"), F.first("__path").alias("__path"))
    urls = urls.withColumn("__labels", F.split("__host", r"\."))
    suffixes = F.filter(
        F.transform(
            F.array(*[F.lit(n) for n in labels]).cast("array<int>"),
            lambda n: F.when(F.size("__labels") >= n, F.array_join(F.slice("__labels", -n, n), ".")),
        ),
        lambda x: x.isNotNull(),
    )
    prefixes = F.filter(
        F.transform(
            F.array(*[F.lit(n) for n in lengths]).cast("array<int>"),
            lambda n: F.when(F.length("__path") >= n, F.substring(F.col("__path"), F.lit(1), n)),
        ),
        lambda x: x.isNotNull(),
    )
    expressions = (
        urls.select("__url", F.explode(suffixes).alias("__s"), prefixes.alias("__ps"))
        .select("__url", "__s", F.explode(F.slice("__ps", F.lit(1), F.size("__ps"))).alias("__p"))
        .select("__url", F.sha2(F.concat_ws("\n", "__s", "__p"), 256).alias("__full"))
        .withColumn("__prefix", F.substring("__full", 1, PREFIX))
    )
    met = expressions.join(small(known, _RULES_TO_BROADCAST), "__prefix").filter("__full = __digest")
    rule = F.struct(F.length("__rule").alias("n"), F.col("verdict").alias("v"), F.col("__rule").alias("r"))
    # A cut point, so that the join below shuffles both sides and can split a hot URL.
    best = cut(met.groupBy("__url").agg(F.max(rule).alias("__best")))
    kept = [F.col(f"__in.`{c}`") for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    joined = pages.alias("__in").join(best.alias("__v"), F.col(f"__in.`{column}`") == F.col("__v.__url"), "left")
    return joined.select(
        *kept,
        host(F.col(f"__in.`{column}`")).alias("host"),
        path(F.col(f"__in.`{column}`")).alias("path"),
        F.col("__best")["r"].alias("rule"),
        F.coalesce(F.col("__best")["v"], F.lit(default)).alias("verdict"),
    )
