"""Mixing sources to target weights: a token budget handed down a tree of groups.

The tree has a level per column of `levels`. A node gets its weighted share of its parent's budget;
where it has too few tokens, what it lacks goes to its siblings, and only what a whole family lacks
to its parent's siblings. Each leaf then takes a prefix of its token stream: its documents in a
seeded order, once per epoch, the last one cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortweave.sources.workspace import stored

LEVELS = ("domain", "lang", "source")
# Passes over a leaf at most, and share of all tokens that the mix has.
MAX_EPOCHS = 2
SHARE = 0.5
SEED = "mix-1"
# Leading hex digits of the order by which a leaf is cut coarsely before it is cut exactly.
COARSE_DIGITS = 3
# Budgets of at most this many leaves (some 100 bytes each) are broadcast.
BROADCAST_LEAVES = 100_000

_WORD = r"[^\x20\x09-\x0D]+"
_WIDE = "decimal(38,0)"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def budgets(leaves: DataFrame, weights: DataFrame | None, total: int, levels: Sequence[str], max_epochs: int) -> DataFrame:
    """(levels..., tokens, budget) of each leaf. `weights` has (level, path, weight); the default is 1.

    Among siblings in order of capacity per weight, a node is full if its share of what the nodes
    before it leave is no less than its capacity; all others share the rest by weight, rounded down.
    Missing groups are the empty string.
    """
    nodes = leaves.select(*levels, "tokens", (F.col("tokens") * max_epochs).cast(_WIDE).alias("capacity"))
    budget = None
    for depth in range(1, len(levels) + 1):
        group, parents = list(levels[:depth]), list(levels[: depth - 1])
        level = nodes.groupBy(*group).agg(F.sum("capacity").cast(_WIDE).alias("capacity"))
        level = level.withColumn("path", F.concat_ws("/", *group))
        if weights is None:
            level = level.withColumn("weight", F.lit(1).cast("long"))
        else:
            level = level.join(weights.select("path", F.col("weight").cast("long")), "path", "left").fillna(1, ["weight"])
        if budget is None:
            level = level.withColumn("parent", F.lit(total).cast(_WIDE))
        else:
            level = level.join(budget.withColumnRenamed("budget", "parent"), parents)
        family = Window.partitionBy(*parents).orderBy(F.col("capacity") / F.col("weight"), "path")
        before = family.rowsBetween(Window.unboundedPreceding, -1)
        since = family.rowsBetween(Window.currentRow, Window.unboundedFollowing)
        level = level.withColumn("_left", F.col("parent") - F.coalesce(F.sum("capacity").over(before), F.lit(0))).withColumn(
            "_weights", F.sum("weight").over(since)
        )
        full = F.col("capacity") * F.col("_weights") <= F.col("_left") * F.col("weight")
        level = level.withColumn("_full", full)
        whole = Window.partitionBy(*parents)
        level = level.withColumn(
            "_rest", F.col("parent") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("capacity"))).over(whole), F.lit(0))
        ).withColumn("_sharing", F.sum(F.when(~F.col("_full"), F.col("weight"))).over(whole))
        budget = level.select(
            *group, F.when(F.col("_full"), F.col("capacity")).otherwise(F.expr("_rest * weight div _sharing")).cast(_WIDE).alias("budget")
        )
    return nodes.join(budget, list(levels)).select(*levels, "tokens", F.col("budget").cast("long").alias("budget"))


def _order(epoch: Column, doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def mix(
    docs: DataFrame, weights: DataFrame | None = None, *, levels: Sequence[str] = LEVELS, share: float = SHARE,
    max_epochs: int = MAX_EPOCHS, seed: str = SEED, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The mix: the documents with `epoch`, `n_words` and `taken_words`, once per epoch that has them.

    `levels` are columns of `docs`; a null level is the group ''. The mix has `share` of all words
    (`[^\\x20\\x09-\\x0D]+`), less if no group may give more within `max_epochs`, and up to a word per
    node less by rounding. A document that is cut keeps its first words, joined by one space.
    Documents without words, null texts among them, belong to no epoch. Equal rows are taken one by one.
    """
    added = ("epoch", "n_words", "taken_words")
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added])
    group = [f"_g{i}" for i in range(len(levels))]
    keyed = docs.withColumns({g: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for g, c in zip(group, levels)})
    narrow = stored(keyed.select(*group, F.col(doc_id).alias("_id"), n_words(F.col(text)).alias("_n")).filter("_n > 0"), "mix-sizes")
    leaves = narrow.groupBy(*group).agg(F.sum("_n").alias("tokens"))
    total = int((narrow.agg(F.sum("_n")).first()[0] or 0) * share)
    plan = budgets(leaves, weights, total, group, max_epochs).withColumn("_epochs", F.expr("budget div tokens")).withColumn(
        "_part", F.expr("budget % tokens")
    )
    plan = stored(plan, "mix-budgets")
    few = plan.count() <= BROADCAST_LEAVES
    order = _order(F.col("_epochs"), F.col("_id"), seed)
    sums = (
        narrow.join(F.broadcast(plan) if few else plan, group).filter("_part > 0")
        .groupBy(*group, "_part", F.substring(order, 1, COARSE_DIGITS).alias("_coarse")).agg(F.sum("_n").alias("_sum"))
    )
    running = F.sum("_sum").over(Window.partitionBy(*group).orderBy("_coarse"))
    cut = (
        sums.withColumn("_end", running).filter((F.col("_end") >= F.col("_part")) & (F.col("_end") - F.col("_sum") < F.col("_part")))
        .select(*group, "_coarse", (F.col("_part") - F.col("_end") + F.col("_sum")).alias("_within"))
    )
    plan = stored(plan.join(cut, group, "left"), "mix-plan")

    source = F.col(f"`{text}`")
    order = _order(F.col("_epochs"), F.col(f"`{doc_id}`"), seed)
    rows = keyed.join(F.broadcast(plan) if few else plan, group).withColumn("_order", order)
    coarse = F.substring("_order", 1, COARSE_DIGITS)
    last = F.when(coarse < F.col("_coarse"), F.col("_epochs") + 1).otherwise(F.col("_epochs"))
    whole = rows.withColumn("n_words", n_words(source)).filter("n_words > 0").withColumn(
        "epoch", F.explode(F.when(last > 0, F.sequence(F.lit(0).cast("long"), last - 1)))
    ).withColumn("taken_words", F.col("n_words"))
    edge = rows.filter(coarse == F.col("_coarse")).withColumn("n_words", n_words(source)).filter("n_words > 0")
    ahead = Window.partitionBy(*group).orderBy("_order", f"`{doc_id}`", "n_words", F.xxhash64(source)).rowsBetween(
        Window.unboundedPreceding, -1
    )
    left = F.col("_within") - F.coalesce(F.sum("n_words").over(ahead), F.lit(0))
    edge = edge.withColumn("taken_words", F.least(F.col("n_words"), left)).filter("taken_words > 0").withColumn("epoch", F.col("_epochs"))
    first = F.array_join(F.slice(F.regexp_extract_all(source, F.lit(_WORD), 0), F.lit(1), F.col("taken_words").cast("int")), " ")
    edge = edge.withColumn(text, F.when(F.col("taken_words") < F.col("n_words"), first).otherwise(source))
    columns = [*[F.col(f"`{c}`") for c in docs.columns], *added]
    return whole.select(*columns).unionByName(edge.select(*columns))
