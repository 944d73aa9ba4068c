"""Mixing sources to target weights by hierarchical budgeting.

Documents hang on a tree (by default domain > lang > source).  Each leaf can give
its tokens ``max_epochs`` times.  The token budget flows down from the root:
siblings share their parent's budget by weight; a child that cannot use its
share is filled and what it leaves goes to its siblings by weight.  A parent's
budget never exceeds what its subtree can give, so a shortage is settled among
siblings first and reaches the parent's siblings only as a whole.  Shares are
integers that add up to the budget exactly.

A leaf with b budgeted and s available tokens gives b div s whole epochs, then
a prefix of the next one: documents in the order of md5(seed|epoch|doc_id) as
long as their running sum stays within b mod s.

Scale: token sums per leaf and first two hex digits of the order are
pre-aggregated, the running sum goes over those at most 256 rows a leaf, the bucket
in which the prefix ends is divided by the next two digits in the same way, and only
the documents of that 65536th part are ordered.  The
answer per leaf is one row, joined back to the documents; texts are not shuffled
where those rows fit a broadcast.

Defined results: null and empty texts have no tokens and are never selected; a
null level value is a node of its own; rows of one doc_id share their place in
the order and are taken or left together (null ids too); weight 0 gives
nothing; values without a weight have weight ``default_weight``; an empty table gives
an empty result; clashing column names are avoided by prefixing ``_``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from warnindex.llm.common import fresh_name, written
from warnindex.session import fits

WORD = "[^ \\t\\n\\x0B\\f\\r]+"
LEAVES_TO_BROADCAST = 20_000
LEVELS = 2  # pairs of hex digits of the order that are pre-aggregated


@dataclass(frozen=True)
class MixParams:
    levels: tuple[str, ...] = ("domain", "lang", "source")
    weights: dict[str, dict[str, int]] = field(default_factory=dict)  # level -> value -> relative weight
    default_weight: int = 1
    budget_share: float | None = 0.8  # of all available tokens, once
    budget_tokens: int | None = None  # or a number
    max_epochs: int = 3
    seed: str = "mix-1"


PRODUCTION = MixParams(weights={
    "domain": {"domain0": 50, "domain1": 30, "domain2": 20},
    "lang": {"en": 50, "fr": 20, "de": 20, "es": 10},
})


def with_domain(docs: DataFrame, source_col: str = "source", name: str = "domain") -> DataFrame:
    """Adds the domain of the sources: their number modulo 3, or ``other``."""
    n = F.regexp_extract(F.coalesce(F.col(source_col), F.lit("")), "([0-9]{1,9})$", 1)
    return docs.withColumn(name, F.when(n == "", F.lit("other")).otherwise(F.concat(F.lit("domain"), (n.cast("int") % 3).cast("string"))))


def n_words(text) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))).cast("long")


def _weight(level: str, key: Column, p: MixParams) -> Column:
    w = F.lit(p.default_weight)
    for value, n in sorted(p.weights.get(level, {}).items()):
        w = F.when(key == "v" + value, F.lit(int(n))).otherwise(w)
    return w.cast("decimal(38,0)")


def _share_out(nodes: DataFrame, parents: list[str], node: str) -> DataFrame:
    """``nodes`` (parents, node, cap, w, budget of the parent) with ``share``."""
    part = Window.partitionBy(*parents)
    order = part.orderBy(F.when(F.col("w") == 0, F.lit(0.0)).otherwise(F.col("cap").cast("double") / F.col("w").cast("double")), node)
    upto, past = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("decimal(38,0)")
    d = nodes.withColumn("cap", F.when(F.col("w") == 0, zero).otherwise(F.col("cap")))
    d = d.withColumn("_before", F.coalesce(F.sum("cap").over(past), zero))
    d = d.withColumn("_left_w", F.sum("w").over(part) - F.coalesce(F.sum("w").over(past), zero))
    d = d.withColumn("_fills", (F.col("cap") * F.col("_left_w") <= (F.col("budget") - F.col("_before")) * F.col("w")).cast("int"))
    d = d.withColumn("_full", F.min("_fills").over(upto) == 1)
    d = d.withColumn("_rest", F.col("budget") - F.sum(F.when(F.col("_full"), F.col("cap")).otherwise(zero)).over(part))
    open_w = F.when(F.col("_full"), zero).otherwise(F.col("w"))
    d = d.withColumn("_open", F.sum(open_w).over(part)).withColumn("_cum", F.sum(open_w).over(upto))
    cut = lambda c: f"cast(cast(_rest as decimal(20,0)) * cast({c} as decimal(18,0)) div cast(_open as decimal(18,0)) as decimal(38,0))"
    share = F.when(F.col("_full"), F.col("cap")).otherwise(F.expr(f"{cut('_cum')} - {cut('(_cum - w)')}"))
    return d.withColumn("share", share).drop("_before", "_left_w", "_fills", "_full", "_rest", "_open", "_cum")


def leaf_budgets(leaves: DataFrame, p: MixParams) -> DataFrame:
    """``leaves``: one row per leaf (level keys, supply); adds ``budget`` in tokens."""
    lv = list(p.levels)
    keys = [f"_k{i}" for i in range(len(lv))]
    num = lambda c: F.col(c).cast("decimal(38,0)")
    base = leaves.withColumn("cap", num("supply") * p.max_epochs)
    # a node whose own or any ancestor's weight is 0 can give nothing, whatever its leaves hold
    for i, level in enumerate(lv):
        base = base.withColumn("cap", F.when(_weight(level, F.col(keys[i]), p) == 0, 0).otherwise(F.col("cap")).cast("decimal(38,0)"))
    total = base.agg(F.coalesce(F.sum("supply"), F.lit(0)).alias("supply"), F.coalesce(F.sum("cap"), F.lit(0)).cast("long").alias("cap")).first()
    goal = p.budget_tokens if p.budget_tokens is not None else math.floor(float(total["supply"]) * p.budget_share)
    root = F.lit(min(int(goal), int(total["cap"]))).cast("decimal(38,0)")
    got, parents = None, []
    for i, level in enumerate(lv):
        nodes = base.groupBy(*parents, keys[i]).agg(F.sum("cap").alias("cap")).withColumn("w", _weight(level, F.col(keys[i]), p))
        nodes = nodes.withColumn("budget", root) if got is None else nodes.join(got, parents)
        nodes = _share_out(nodes, parents, keys[i])
        parents = parents + [keys[i]]
        got = nodes.select(*parents, F.col("share").alias("budget"))
    return leaves.join(got, keys)


def _order_key(seed: str, epoch, doc_id) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))


def plan(docs: DataFrame, p: MixParams = PRODUCTION, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(slim, leaves): one slim row per document (level keys, doc_id, n_tokens) and
    one row per leaf (level keys, supply, budget, epochs, rest, bucket, last key)."""
    keys = [f"_k{i}" for i in range(len(p.levels))]
    slim = docs.select(*[F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")).alias(k) for k, c in zip(keys, p.levels)],
                       F.col(id_col).alias("_id"), n_words(F.col(text_col)).alias("_n"))
    slim = written(slim, "mix-tokens")
    leaves = written(slim.groupBy(*keys).agg(F.sum("_n").cast("long").alias("supply")).filter("supply > 0"), "mix-supply")
    leaves = leaf_budgets(leaves, p).withColumn("budget", F.col("budget").cast("long"))
    leaves = written(leaves.withColumn("epochs", F.expr("budget div supply")).withColumn("rest", F.expr("budget % supply")), "mix-leaves")
    small = F.broadcast(leaves) if fits(leaves, LEAVES_TO_BROADCAST) else leaves
    placed = slim.filter("_n > 0").join(small.filter("rest > 0"), keys).withColumn("_key", _order_key(p.seed, F.col("epochs"), F.col("_id")))
    tail = placed.withColumn("before", F.lit(0).cast("long"))
    for d in range(1, LEVELS + 1):
        # the running sum over the next two digits: at most 256 rows a leaf; the one in which the rest ends is looked into
        b = F.substring("_key", 2 * d - 1, 2)
        sums = tail.groupBy(*keys, b.alias("_b")).agg(F.sum("_n").alias("t"), F.first("rest").alias("rest"), F.first("before").alias("before"))
        run = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
        sums = sums.withColumn("upto", F.sum("t").over(run) + F.col("before"))
        ends = sums.filter("upto > rest and upto - t <= rest").select(*keys, F.col("_b").alias("end_b"), (F.col("upto") - F.col("t")).alias("start"))
        ends = written(ends, "mix-ends")
        small_ends = F.broadcast(ends) if fits(ends, LEAVES_TO_BROADCAST) else ends
        tail = tail.join(small_ends, keys).filter(F.substring("_key", 2 * d - 1, 2) == F.col("end_b")).drop("before", "end_b").withColumnRenamed("start", "before")
        prefix = ends.select(*keys, F.col("end_b").alias("p")) if d == 1 else prefix.join(ends, keys).select(*keys, F.concat("p", "end_b").alias("p"))
    tail = tail.groupBy(*keys, "_key").agg(F.sum("_n").alias("t"), F.first("before").alias("before"), F.first("rest").alias("rest"))
    run = Window.partitionBy(*keys).orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)
    last = tail.withColumn("upto", F.sum("t").over(run) + F.col("before")).filter("upto <= rest")
    last = last.groupBy(*keys).agg(F.max("_key").alias("last_key"))
    # rest < supply, so a leaf with a rest always has a prefix in which it ends
    done = leaves.join(prefix.withColumnRenamed("p", "end_b"), keys, "left").join(last, keys, "left")
    return slim, written(done, "mix-plan")


def _copies(p: MixParams, doc_id, has_tokens) -> Column:
    key = _order_key(p.seed, F.col("epochs"), doc_id)
    head = F.substring(key, 1, 2 * LEVELS)
    part = (F.col("rest") > 0) & ((head < F.col("end_b")) | ((head == F.col("end_b")) & (key <= F.col("last_key"))))
    return F.when(has_tokens & F.col("epochs").isNotNull(), F.col("epochs") + F.coalesce(part, F.lit(False)).cast("long")).otherwise(F.lit(0)).cast("int")


def copies(docs: DataFrame, p: MixParams = PRODUCTION, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, level values, n_tokens, copies (0: not selected)."""
    keys = [f"_k{i}" for i in range(len(p.levels))]
    slim, leaves = plan(docs, p, id_col, text_col)
    small = F.broadcast(leaves) if fits(leaves, LEAVES_TO_BROADCAST) else leaves
    value = lambda k: F.when(F.col(k) == "n", F.lit(None).cast("string")).otherwise(F.expr(f"substring({k}, 2)"))
    return slim.join(small, keys, "left").select(
        F.col("_id").alias(id_col), *[value(k).alias(c) for k, c in zip(keys, p.levels)], F.col("_n").alias("n_tokens"),
        _copies(p, F.col("_id"), F.col("_n") > 0).alias("copies"))


def mix(docs: DataFrame, p: MixParams = PRODUCTION, id_col: str = "doc_id", text_col: str = "text", name: str = "copies") -> DataFrame:
    """The selected documents, all their columns and how many times each is to be used."""
    keys = [f"_k{i}" for i in range(len(p.levels))]
    name = fresh_name(docs, name)
    _, leaves = plan(docs, p, id_col, text_col)
    small = F.broadcast(leaves) if fits(leaves, LEAVES_TO_BROADCAST) else leaves
    d = docs.alias("d")
    on = [F.coalesce(F.concat(F.lit("v"), F.col(f"d.{c}").cast("string")), F.lit("n")) == F.col(f"m.{k}") for k, c in zip(keys, p.levels)]
    m = small.alias("m")
    n = _copies(p, F.col(f"d.{id_col}"), F.col(f"d.{text_col}").rlike(WORD))
    return d.join(m, on).select("d.*", n.alias(name)).filter(F.col(name) > 0)


def mix_by_source(docs: DataFrame, p: MixParams = PRODUCTION) -> DataFrame:
    """``mix`` over the tree of domains (read off the sources), langs and sources; the columns of
    ``docs`` stay as they are, also one called ``domain``."""
    name = fresh_name(docs, "domain")
    called = lambda level: name if level == "domain" else level
    p = replace(p, levels=tuple(map(called, p.levels)), weights={called(k): w for k, w in p.weights.items()})
    return mix(with_domain(docs, name=name), p).drop(name)
