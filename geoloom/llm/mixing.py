"""Mixing sources to target weights by hierarchical budgets, in DataFrame functions only.

Leaves are (domain, language, source). The token budget flows down the tree in
proportion to the weights of siblings. A node cannot take more than its
capacity, the tokens of its leaves times ``max_epochs``; what it cannot take
goes to its siblings by weight, and only what none of them can take is left to
the siblings of their parent. Per leaf, whole epochs are taken as long as they
fit; of the next epoch the prefix that fits, in an order seeded by epoch.

Budgets are whole tokens, rounded down. Prefix ends come from sums over
(leaf, block of the order), so no task orders a whole leaf, and the texts are
never shuffled: each document compares its own place with its leaf's end.

Defined results: null domains, languages and sources count as the empty name;
null and empty texts have no tokens and come along with the prefix or the epochs
of their leaf, but a leaf without tokens gives no rows; repeated rows (equal key)
share one place and stay or go together; rows with a null key are placed by
their text; an empty table gives no rows; further columns are kept, but for
``epoch`` and ``tokens``, which are replaced.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from geoloom.llm.common import WORD, prefix_offsets, written

SEED = 42
MAX_EPOCHS = 2
#: Hex digits of the seeded order that form a block: 4,096 blocks for each leaf.
DIGITS = 3

Weights = Sequence[tuple[str, Mapping[str, int]]]


def words(text: Column) -> Column:
    """Words of a text, the token count that needs no vocabulary."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _share(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Children of all parents with ``budget``: the parent's ``given`` shared by ``weight`` within ``capacity``."""
    by = W.partitionBy(*[F.col(p) for p in parent] or [F.lit(0)]).orderBy(
        (F.col("capacity").cast("double") / F.nullif("weight", F.lit(0))).asc_nulls_last(), name
    )
    every = W.partitionBy(*[F.col(p) for p in parent] or [F.lit(0)])
    big = lambda c: F.col(c).cast("decimal(18,0)")
    rows = children.withColumns({
        "w_left": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(by.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
        "b_left": F.col("given") - F.coalesce(F.sum("capacity").over(by.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
    })
    rows = rows.withColumn("full", (F.col("weight") > 0) & (big("capacity") * big("w_left") <= big("weight") * big("b_left")))
    rows = rows.withColumns({
        "w_open": F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0)).over(every),
        "b_open": F.col("given") - F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(every),
    })
    part = F.expr("cast(weight as decimal(18,0)) * cast(b_open as decimal(18,0)) div nullif(w_open, 0)").cast("bigint")
    budget = F.when(F.col("full"), F.col("capacity")).otherwise(F.coalesce(part, F.lit(0)))
    return rows.withColumn("budget", budget).drop("w_left", "b_left", "full", "w_open", "b_open", "given")


def budgets(leaves: DataFrame, total: int, weights: Weights, *, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``leaves`` (one row for each, with ``tokens``) plus ``budget``: whole tokens for each leaf.

    ``weights`` lists the levels from the root down: (column, weight of each
    name); names without a weight have weight 1.
    """
    levels = [name for name, _ in weights]
    nodes = leaves.withColumn("capacity", F.col("tokens") * max_epochs)
    above: DataFrame | None = None
    for depth, (level, given) in enumerate(weights):
        keys, parent = levels[: depth + 1], levels[:depth]
        known = F.create_map(*[F.lit(x) for kv in given.items() for x in kv]) if given else None
        weight = F.coalesce(F.try_element_at(known, F.col(level)), F.lit(1)) if given else F.lit(1)
        rows = nodes.groupBy(*keys).agg(F.sum("capacity").alias("capacity")).withColumn("weight", weight.cast("bigint"))
        if above is None:
            # The whole tree cannot take more than its capacity.
            rows = rows.withColumn("given", F.lit(total).cast("bigint"))
        else:
            rows = rows.join(above.select(*parent, F.col("budget").alias("given")), parent)
        above = _share(rows, parent, level)
    return leaves.join(above.select(*levels, "budget"), levels)


def mixed(docs: DataFrame, weights: Weights, *, budget: int | None = None, share: float = 1.0, max_epochs: int = MAX_EPOCHS,
          seed: int = SEED, key: str = "doc_id", text: str = "text", tokens: Column | None = None) -> DataFrame:
    """Rows of ``docs``, once for each epoch they are taken in, with ``epoch`` (from 0) and ``tokens``.

    ``budget`` is the total in tokens; without it, ``share`` of all tokens. The
    columns named in ``weights`` must be in ``docs``.
    """
    levels = [name for name, _ in weights]
    kept = [c for c in docs.columns if c.lower() not in ("epoch", "tokens")]
    count = words(F.col(text)) if tokens is None else tokens
    own = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(F.col(text), F.lit("")))))
    leaf = {f"__{n}": F.coalesce(F.col(n).cast("string"), F.lit("")) for n in levels}
    light = docs.select(*[c.alias(n) for n, c in leaf.items()], own.alias("own"), count.alias("tokens"))
    light = written(light, "mix")  # keys and counts only
    leaves = light.groupBy(*leaf).agg(F.sum("tokens").alias("tokens"))
    total = budget
    if total is None:
        total = int((leaves.agg(F.sum("tokens").alias("t")).first()["t"] or 0) * share)
    plan = budgets(leaves, total, [(f"__{n}", w) for n, w in weights], max_epochs=max_epochs).where("tokens > 0")
    plan = plan.select(*leaf, F.expr("budget div tokens").alias("epochs"), (F.col("budget") % F.col("tokens")).alias("rest"))
    # Written, so that the planner knows how small it is and need not bring whole leaves together.
    plan = written(plan, "mix-budgets")
    # Place of every document in the epoch of which its leaf takes a prefix.
    order = lambda own: F.md5(F.concat(F.lit(f"{seed}:"), F.col("epochs").cast("string"), F.lit(":"), own))
    placed = light.join(plan, list(leaf)).withColumn("place", order(F.col("own")))
    block = F.conv(F.substring("place", 1, DIGITS), 16, 10).cast("bigint")
    placed = placed.withColumn("block", block)
    sums = placed.groupBy(*leaf, "block").agg(F.sum("tokens").alias("n"))
    before = prefix_offsets(sums, list(leaf), "block", "n", "before").drop("n")
    inside = W.partitionBy(*leaf, "block").orderBy("place")  # equal places share their sum
    upto = placed.withColumn("upto", F.sum("tokens").over(inside)).join(before, [*leaf, "block"])
    ends = upto.where("upto + before <= rest").groupBy(*leaf).agg(F.max("place").alias("end"))
    plan = written(plan.join(ends, list(leaf), "left"), "mix-plan")
    # The documents' own columns stay in a struct, apart from those made here.
    rows = docs.select(F.struct(*kept).alias("row"), *[c.alias(n) for n, c in leaf.items()], own.alias("own"), count.alias("tokens"))
    rows = rows.join(plan, list(leaf))
    times = F.col("epochs") + F.when((F.col("epochs") < max_epochs) & (order(F.col("own")) <= F.col("end")), 1).otherwise(0)
    rows = rows.withColumn("times", times.cast("int")).where("times > 0")
    epoch = F.explode(F.sequence(F.lit(0), F.col("times") - 1)).alias("epoch")
    return rows.select(*[F.col("row")[c].alias(c) for c in kept], epoch, "tokens")
