"""Mixing documents to target weights over a tree of domain, language and source.

The token budget is handed down the tree by the weights of siblings. A child that cannot
hold its share leaves the rest to its siblings; only what a whole subtree cannot hold goes
to the subtree's own siblings. A leaf's quota is filled by whole seeded epochs and the
token-prefix of one more. All orders are by hash, found bucket by bucket, so no leaf is
sorted as a whole.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courierlens.llm.blocks import scratch_table

NONE = "?"
LEVELS = ["domain", "language", "origin"]
LEAF = LEVELS
# hex digits of the hash that number the buckets of an epoch: 4096 buckets
BUCKET = 3


@dataclass(frozen=True)
class Mix:
    """Whole-number weights of tree nodes by their path; an unlisted node has weight 1.

    ``domains`` maps a source to its domain; other sources are of domain ``other``.
    ``share`` is the budget as a part of all tokens, ``epochs`` how often a document may
    be taken, ``seed`` what all orders hang on.
    """

    domains: dict[str, str] = field(default_factory=dict)
    weights: dict[tuple[str, ...], int] = field(default_factory=dict)
    share: float = 0.8
    epochs: int = 4
    seed: int = 20


def tokens(text: Column) -> Column:
    """Words between ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def leaf_columns(mix: Mix) -> dict[str, Column]:
    origin = F.coalesce("source", F.lit(NONE))
    domain = F.lit("other")
    for source, name in sorted(mix.domains.items()):
        domain = F.when(origin == source, name).otherwise(domain)
    return {"domain": domain, "language": F.coalesce("lang", F.lit(NONE)), "origin": origin}


def weight_of(level: int, mix: Mix) -> Column:
    weight = F.lit(1)
    for path, value in sorted(mix.weights.items()):
        if len(path) == level:
            same = F.lit(True)
            for column, name in zip(LEVELS, path, strict=False):
                same &= F.col(column) == name
            weight = F.when(same, value).otherwise(weight)
    return weight.cast("double")


def order_key(mix: Mix, epoch: Column, row: Column) -> Column:
    """Place of a row in an epoch of its leaf."""
    return F.md5(F.concat_ws("|", F.lit(str(mix.seed)), epoch.cast("string"), row))


def row_key(doc_id: Column, text: Column) -> Column:
    """What a row is told apart by: its id and text."""
    return F.md5(F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit(""))))


def hand_down(children: DataFrame, parent: list[str], budget: Column) -> DataFrame:
    """``given`` of each child: the smaller of its capacity and its weight times the siblings' water level.

    With the children ordered by capacity per weight, the level is the largest of (budget
    less the capacities before) / (weights from here on).
    """
    group = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = group.orderBy("ratio", *LEVELS[: len(parent) + 1])
    some = children.withColumn("ratio", F.col("capacity") / F.col("weight"))
    before = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = F.max((budget - before) / rest).over(group)
    return some.withColumn("given", F.least(F.col("capacity").cast("double"), F.col("weight") * level)).drop("ratio")


def leaf_quotas(leaves: DataFrame, mix: Mix) -> DataFrame:
    """Quota of each leaf of (domain, language, origin, tokens); leaves without quota are left out.

    A node can hold what its leaves of weight above 0 all the way down can: what a subtree
    cannot take goes to the siblings of its top.
    """
    leaves = leaves.withColumn("capacity", F.col("tokens") * mix.epochs)
    total = leaves.agg(F.floor(F.sum("tokens") * F.lit(mix.share)).alias("budget"))
    for level in (1, 2, 3):
        leaves = leaves.where(weight_of(level, mix) > 0)
    given, budget = leaves.limit(0), None
    for level in (1, 2, 3):
        path = LEVELS[:level]
        nodes = leaves.groupBy(*path).agg(F.sum("capacity").alias("capacity"))
        nodes = nodes.withColumn("weight", weight_of(level, mix))
        if level == 1:
            # one row: the budget
            nodes = nodes.withColumn("all", F.lit(1)).join(total.withColumn("all", F.lit(1)), "all").drop("all")
        else:
            budget = given.select(*LEVELS[: level - 1], F.col("given").alias("budget"))
            nodes = nodes.join(budget, LEVELS[: level - 1])
        given = hand_down(nodes, LEVELS[: level - 1], F.col("budget"))
    return given.select(*LEAF, F.floor("given").cast("long").alias("quota")).where("quota > 0")


def plan_mix(docs: DataFrame, mix: Mix) -> tuple[DataFrame, DataFrame]:
    """The slim rows (leaf, doc_id, row, tokens), and per leaf its quota, whole epochs and last key taken.

    Rows that tie, that is equal ids with equal texts, are taken together or not at all.
    """
    slim = scratch_table(
        docs.select(
            *[c.alias(n) for n, c in leaf_columns(mix).items()],
            F.col("doc_id").cast("long").alias("doc_id"),
            row_key(F.col("doc_id"), F.col("text")).alias("row"),
            tokens(F.col("text")).alias("tokens"),
        ),
        "mix-rows",
    )
    leaves = slim.groupBy(*LEAF).agg(F.sum("tokens").alias("tokens"))
    quotas = leaf_quotas(leaves, mix).join(leaves, LEAF)
    # the leaf table has a row per leaf; the joins below let Spark broadcast it if it is small
    quotas = scratch_table(
        quotas.select(
            *LEAF,
            "quota",
            F.floor(F.col("quota") / F.col("tokens")).cast("int").alias("whole"),
            (F.col("quota") % F.col("tokens")).alias("rest"),
        ),
        "mix-quotas",
    )
    keyed = slim.join(quotas, LEAF).withColumn("key", order_key(mix, F.col("whole"), F.col("row")))
    keyed = keyed.withColumn("bucket", F.substring("key", 1, BUCKET))
    sums = keyed.groupBy(*LEAF, "rest", "bucket").agg(F.sum("tokens").alias("tokens"))
    through = F.sum("tokens").over(Window.partitionBy(*LEAF).orderBy("bucket"))
    sums = sums.withColumn("through", through)
    # the bucket in which the quota ends; what its leaf took before
    edge = sums.where((F.col("through") > F.col("rest")) & (F.col("through") - F.col("tokens") <= F.col("rest")))
    edge = edge.groupBy(*LEAF).agg(
        F.min(F.struct("bucket", (F.col("through") - F.col("tokens")).alias("before"))).alias("edge")
    )
    edge = scratch_table(edge, "mix-edges")
    inside = keyed.join(edge, LEAF).where("bucket = edge.bucket").groupBy(*LEAF, "key", "rest", "edge")
    inside = inside.agg(F.sum("tokens").alias("tokens"))
    run = F.sum("tokens").over(Window.partitionBy(*LEAF).orderBy("key")) + F.col("edge.before")
    cuts = inside.withColumn("run", run).where("run <= rest").groupBy(*LEAF).agg(F.max("key").alias("last"))
    plan = quotas.join(edge, LEAF, "left").join(cuts, LEAF, "left")
    # keys up to ``last`` are taken: all of the epoch, up to a key, or those before the edge's bucket
    upto = F.when(F.col("edge").isNull(), F.lit("g")).otherwise(F.coalesce("last", "edge.bucket"))
    return slim, scratch_table(plan.select(*LEAF, "quota", "whole", "rest", upto.alias("upto")), "mix-plan")


def _epochs(mix: Mix) -> Column:
    """The epochs in which a row is taken: every whole one, and the next if its key is in the prefix."""
    whole, none = F.col("whole"), F.array().cast("array<int>")
    last = (F.col("rest") > 0) & (order_key(mix, whole, F.col("row")) <= F.col("upto"))
    all_of = F.when(whole > 0, F.sequence(F.lit(0), whole - 1)).otherwise(none)
    return F.concat(all_of, F.when(last, F.array(whole)).otherwise(none))


def mix_documents(docs: DataFrame, mix: Mix) -> DataFrame:
    """One row per document and epoch taken: doc_id, epoch, n_tokens, domain, language, origin, quota.

    * A null language or source is the node ``?``. Null ids are kept; a null or empty text has
      no tokens and comes with the epochs its place falls in.
    * Equal rows are taken together. Weight 0 takes nothing. A leaf without tokens gives nothing.
    * The sum over a leaf is at most its quota, and less than one document below it.
    * Extra columns are ignored; an empty table gives no rows.
    """
    slim, plan = plan_mix(docs, mix)
    taken = slim.join(plan, LEAF).withColumn("epoch", F.explode(_epochs(mix)))
    return taken.select("doc_id", F.col("epoch").cast("long").alias("epoch"), F.col("tokens").alias("n_tokens"), *LEAF, "quota")


def mixed_rows(docs: DataFrame, mix: Mix) -> DataFrame:
    """The rows of ``docs`` taken, with all their columns, once per epoch."""
    _, plan = plan_mix(docs, mix)
    # the row travels as one value, so that none of its columns can clash with the plan's
    keyed = docs.select(
        F.struct(*docs.columns).alias("taken_row"),
        *[c.alias(n) for n, c in leaf_columns(mix).items()],
        row_key(F.col("doc_id"), F.col("text")).alias("row"),
    )
    return keyed.join(plan, LEAF).withColumn("epoch", F.explode(_epochs(mix))).select("taken_row.*")


def mix_sql(mix: Mix) -> str:
    """The same rows as plain SQL over the view ``documents``, without buckets."""
    domain = " ".join(f"WHEN '{s}' THEN '{d}'" for s, d in sorted(mix.domains.items()))

    def weight(level: int) -> str:
        cases = ""
        for path, value in sorted(mix.weights.items()):
            if len(path) == level:
                same = " AND ".join(f"{c} = '{v}'" for c, v in zip(LEVELS, path, strict=False))
                cases += f" WHEN {same} THEN {value}"
        return f"CASE{cases} ELSE 1 END" if cases else "1"

    def level(n: int, parent: str) -> str:
        path = ", ".join(LEVELS[:n])
        over = ", ".join(LEVELS[: n - 1]) or "1"
        return f"""
nodes{n} AS (
  SELECT {path}, capacity, weight, budget, capacity::DOUBLE / weight AS ratio
  FROM (SELECT {path}, sum(capacity)::BIGINT AS capacity, ({weight(n)})::DOUBLE AS weight
        FROM usable GROUP BY {path}) {parent}
), levels{n} AS (
  SELECT *, (budget - coalesce(sum(capacity) OVER (PARTITION BY {over} ORDER BY ratio, {path}
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (PARTITION BY {over} ORDER BY ratio, {path}
                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM nodes{n}
), given{n} AS (
  SELECT {path}, least(capacity::DOUBLE, weight * max(level) OVER (PARTITION BY {over})) AS given FROM levels{n}
)"""

    return f"""
WITH slim AS (
  SELECT CASE coalesce(source, '{NONE}') {domain} ELSE 'other' END AS domain, coalesce(lang, '{NONE}') AS language,
         coalesce(source, '{NONE}') AS origin, doc_id,
         md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')) AS row_key,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS tokens
  FROM documents
), leaves AS (
  SELECT domain, language, origin, sum(tokens)::BIGINT AS tokens, sum(tokens)::BIGINT * {mix.epochs} AS capacity
  FROM slim GROUP BY ALL
), total AS (SELECT floor(sum(tokens) * {mix.share}::DOUBLE) AS budget FROM leaves),
usable AS (SELECT * FROM leaves WHERE {" AND ".join(f"({weight(n)}) > 0" for n in (1, 2, 3))}),
{level(1, "CROSS JOIN total")},
{level(2, "JOIN (SELECT domain, given AS budget FROM given1) USING (domain)")},
{level(3, "JOIN (SELECT domain, language, given AS budget FROM given2) USING (domain, language)")},
plan AS (
  SELECT domain, language, origin, quota, (quota // tokens)::INT AS whole, quota % tokens AS rest
  FROM (SELECT *, floor(given)::BIGINT AS quota FROM given3) JOIN leaves USING (domain, language, origin)
  WHERE quota > 0
), keyed AS (
  SELECT slim.*, quota, whole, rest, md5('{mix.seed}|' || whole || '|' || row_key) AS key
  FROM slim JOIN plan USING (domain, language, origin)
), runs AS (
  SELECT *, sum(tokens) OVER (PARTITION BY domain, language, origin ORDER BY key) AS run FROM keyed
), taken AS (
  SELECT *, unnest(range(whole))::BIGINT AS epoch FROM runs
  UNION ALL
  SELECT *, whole::BIGINT AS epoch FROM runs WHERE run <= rest AND rest > 0
)
SELECT doc_id, epoch, tokens AS n_tokens, domain, language, origin, quota FROM taken
"""
