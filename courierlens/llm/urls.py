"""URL filter by hashed host-suffix and path-prefix expressions.

Every url is expanded into expressions ``host suffix + path prefix``; their SHA-256
digests meet the rules' digests by an equi-join on a short prefix, and the full digest
confirms a match. Only the suffix depths and prefix lengths that some rule has can match,
so an url yields at most (distinct depths) x (distinct lengths) expressions.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# hex digits of the digest that the join compares first: 32 bits
SHORT = 8


class Rule(NamedTuple):
    """One rule: an action for a host with its subdomains, below a path."""

    action: str
    host: str
    path: str


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def expressions(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The digests of all expressions of an url that some rule could have."""
    depths = sorted({r.host.count(".") + 1 for r in rules})
    lengths = sorted({len(r.path) for r in rules})
    labels = F.size(F.split(host, r"\.", -1))
    found = [
        F.when(
            (labels >= d) & (F.length(path) >= n),
            F.sha2(F.concat(F.substring_index(host, ".", -d), F.lit("\n"), F.substring(path, 1, n)), 256),
        )
        for d in depths
        for n in lengths
    ]
    return F.filter(F.array(*found), lambda x: x.isNotNull()) if found else F.array().cast("array<string>")


def rule_table(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """Digests and precedence of the rules: the longest wins, then the longer host, then block."""
    named = ("action", "rule_host", "rule_path")
    given = [F.struct(*[F.lit(v).alias(n) for n, v in zip(named, r, strict=True)]) for r in rules]
    listed = F.array(*given) if given else F.array().cast("array<struct<action:string,rule_host:string,rule_path:string>>")
    table = pages.sparkSession.range(1).select(F.inline(listed))
    digest = F.sha2(F.concat("rule_host", F.lit("\n"), "rule_path"), 256)
    return table.select(
        F.substring(digest, 1, SHORT).alias("short"),
        digest.alias("full"),
        F.struct(
            (F.length("rule_host") + F.length("rule_path")).alias("size"),
            F.length("rule_host").alias("host_size"),
            "action",
            F.concat("rule_host", "rule_path").alias("rule"),
        ).alias("fit"),
    )


def judge_urls(pages: DataFrame, rules: list[Rule], key: str = "page_id", default: str = "allow") -> DataFrame:
    """One row per row of ``pages``: ``key``, host, path, rule and verdict.

    * A null url or one without ``://`` has an empty host and path and meets only a rule
      whose path is empty and whose host is empty, that is none in practice: ``default``.
    * Repeated rows and null keys come back as often as they are given. Equal rows of one
      input partition are judged once; the partition id keeps such a group bounded by it.
    * Other columns of ``pages`` are ignored, so their names cannot clash.
    * Of rules that fit, the longest (host and path together) wins, then the longer host.
    * No rules or no pages: every url gets ``default``; an empty table gives no row.
    """
    seen = (
        pages.select(F.col(key).alias("key"), F.col("url").alias("url"), F.spark_partition_id().alias("part"))
        .groupBy("key", "url", "part")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    )
    asked = seen.withColumn("full", F.explode_outer(expressions(F.col("host"), F.col("path"), rules))).withColumn(
        "short", F.substring("full", 1, SHORT)
    )
    known = rule_table(pages, rules).withColumnRenamed("full", "known")
    best = (
        asked.join(known, "short", "left")
        .groupBy("key", "url", "part", "copies", "host", "path")
        .agg(F.max(F.when(F.col("full") == F.col("known"), F.col("fit"))).alias("best"))
    )
    return best.select(
        F.col("key").alias(key),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
    ).drop("copy")


def judge_sql(rules: list[Rule], default: str = "allow") -> str:
    """The same verdicts as plain SQL over the view ``pages``."""
    values = ", ".join(f"('{r.action}', '{r.host}', '{r.path}')" for r in rules)
    return f"""
WITH parts AS (
  SELECT row_number() OVER () AS row_id, page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), rules(action, rule_host, rule_path) AS (VALUES {values}),
best AS (
  SELECT p.row_id,
         max_by(r.rule_host || r.rule_path,
                length(r.rule_host || r.rule_path) * 100000 + length(r.rule_host)) AS rule,
         max_by(r.action, length(r.rule_host || r.rule_path) * 100000 + length(r.rule_host)) AS action
  FROM parts p JOIN rules r
    ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
  GROUP BY p.row_id
)
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.action, '{default}') AS verdict
FROM parts p LEFT JOIN best b USING (row_id)
"""
