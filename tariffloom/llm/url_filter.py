"""URL filters: host-suffix and path-prefix expressions, joined on short hash prefixes, confirmed by full digests.

A URL's host runs from after the first ``://`` to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; its path from
there to ``?``, ``#`` or the end. NULL, or no ``://``: both are empty. A rule (host, path) fits its host and all
subdomains if the URL's path starts with the rule's path.

Only the expressions that can meet a rule are made: those with a number of host labels and a path length that
occur together in a rule. An expression and a rule meet if the first 32 bits of their SHA-256 agree (equi-join), and
count as equal only if the whole digests do.

Of several fitting rules the longest wins (characters of host and path together), then the longer host, then block
before allow. With no fitting rule the verdict is ``default`` and the rule is NULL.

Cases: NULL or malformed URLs, and an empty host, fit no rule; a URL without a path fits only rules with an empty one.
Repeated rows are judged one by one and all returned; empty tables give an empty result; other columns are not read
unless named in ``keep``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: verdict, host, path
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Rules from literals: verdict, host, path. Longer lists come from a stored table of the same columns."""
    structs = [F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in rules]
    if not structs:
        return spark.range(0).select(*[F.lit("").alias(c) for c in ("verdict", "host", "path")])
    return spark.range(1).select(F.inline(F.array(*structs)))


def split_url(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise("")
    host = F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*", 0)
    path = F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def short(digest: Column) -> Column:
    """The first 32 bits of a hexadecimal digest."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def expression_digest(host: Column, path: Column) -> Column:
    """A host holds no ``/``, so the text before the mark is unambiguous; a path length tells it from longer ones."""
    return F.sha2(F.concat_ws("\n", host, path), 256)


def apply_rules(pages: DataFrame, rules: DataFrame, url: str = "url", keep: Sequence[str] = ("page_id",),
                default: str = "allow") -> DataFrame:
    """Per row of ``pages``: the ``keep`` columns, host, path, rule, verdict.

    ``rules``: verdict, host, path. The shapes of the rules, read as a scalar subquery, are pairs of a label count
    and a path length: their number is bounded by the lengths of rules, not by the number of rules or pages. The rule
    side is broadcast only where Spark's own size estimate allows; otherwise skewed expressions are split by it.
    """
    host, path = split_url(F.col(url))
    known = rules.filter("host is not null and path is not null and host <> ''").select(
        "verdict", F.lower("host").alias("rule_host"), F.col("path").alias("rule_path"))
    shapes = known.agg(F.collect_set(F.struct(
        labels(F.col("rule_host")).alias("n"), F.length("rule_path").alias("size"))).alias("shapes"))
    digest = expression_digest(F.col("rule_host"), F.col("rule_path"))
    known = known.select(
        digest.alias("rule_digest"), short(digest).alias("rule_short"),
        F.struct(
            (F.length("rule_host") + F.length("rule_path")).alias("size"), F.length("rule_host").alias("host_size"),
            (F.col("verdict") == "block").cast("int").alias("blocks"), "verdict",
            F.concat("rule_host", "rule_path").alias("rule"),
        ).alias("found"),
    )

    rows = pages.select(
        F.monotonically_increasing_id().alias("_row"), F.struct(*[F.col(f"`{c}`").alias(c) for c in keep]).alias("_kept"),
        host.alias("host"), path.alias("path"), shapes.scalar().alias("shapes"),
    ).withColumn("shape", F.explode_outer(F.filter(
        "shapes", lambda s: (s["n"] <= labels(F.col("host"))) & (s["size"] <= F.length("path")))))
    rows = rows.withColumn("digest", F.when(
        F.col("shape").isNotNull(), expression_digest(
            F.expr("substring_index(host, '.', -shape.n)"), F.expr("substring(path, 1, shape.size)"))))
    return (
        rows.withColumn("short", short(F.col("digest")))
        .join(known, F.col("short") == F.col("rule_short"), "left")
        .groupBy("_row")
        .agg(
            F.first("_kept").alias("_kept"), F.first("host").alias("host"), F.first("path").alias("path"),
            F.max(F.when(F.col("digest") == F.col("rule_digest"), F.col("found"))).alias("best"),
        )
        .select("_kept.*", "host", "path", F.col("best.rule").alias("rule"),
                F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
    )
