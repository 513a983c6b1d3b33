"""Mixing sources to target weights through a tree, with whole-token budgets.

The budget goes down the tree (domain, language, source): among siblings in
proportion to their weights, but to none more than all its leaves can give in
the allowed epochs. What a child cannot use its siblings get, and only what a
whole subtree cannot use goes back to the level above. A leaf fills its budget
from its documents in a seeded order, a new order each epoch, up to the exact
token; the document at the end is cut. Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corbel.llm.common import WORD, quoted, settle

#: Bits of the seeded order, and of its first and second look at where a budget ends.
BITS, FIRST, SECOND = 52, 12, 24
BIG = "decimal(38,0)"


def count_words(text: Column) -> Column:
    """Words of a text; none in a null one."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def first_words(text: Column, n: Column) -> Column:
    """The beginning of a text up to the end of its n-th word."""
    parts = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    return F.array_join(F.slice(parts, F.lit(1), n.cast("int")), "")


def node_name(value: Column) -> Column:
    """A name that is never null: ``=`` and the value, or nothing for null."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def _weight(level: Column, weights: dict[str, int]) -> Column:
    cases = [F.when(level == f"={name}", F.lit(w)) for name, w in weights.items()]
    return F.coalesce(*cases, F.lit(1)).cast("bigint")


def share_out(nodes: DataFrame, parents: list[str]) -> DataFrame:
    """Give each parent's ``amount`` to its children: adds ``given``.

    Needs ``capacity`` and ``weight``, positive. Children are taken in the order of
    capacity for weight; as long as a child's capacity is at most its share of
    what is left it gets all it can use, and the others divide the rest.
    """
    siblings = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    order = siblings.orderBy(F.col("capacity") / F.col("weight"), "node")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)

    def total(column: Column, over) -> Column:
        return F.coalesce(F.sum(column).over(over), F.lit(0)).cast(BIG)

    capacity, weight, amount = (F.col(c).cast(BIG) for c in ("capacity", "weight", "amount"))
    left = total(F.col("weight"), siblings) - total(F.col("weight"), before)
    full = capacity * left <= weight * (amount - total(F.col("capacity"), before))
    marked = nodes.withColumn("full", full)
    open_weight = F.when(F.col("full"), 0).otherwise(F.col("weight"))
    used = F.when(F.col("full"), F.col("capacity")).otherwise(0)
    summed = marked.select(
        "*",
        total(used, siblings).alias("used"),
        total(open_weight, siblings).alias("open"),
        total(open_weight, so_far).alias("upto"),
    )
    given = F.expr(
        f"(cast(amount - used AS {BIG}) * upto) div greatest(open, 1)"
        f" - (cast(amount - used AS {BIG}) * (upto - weight)) div greatest(open, 1)"
    )
    return summed.select(
        *nodes.columns,
        F.when(F.col("full"), F.col("capacity")).otherwise(given).cast("bigint").alias("given"),
    )


def budgets(
    leaves: DataFrame,
    levels: list[str],
    weights: list[dict[str, int]],
    share: tuple[int, int],
    epochs: int,
) -> DataFrame:
    """Tokens that each leaf gives: ``leaves`` (level names, ``tokens``) and ``given``."""
    able = leaves.withColumn("capacity", F.col("tokens") * epochs)
    everything = Window.partitionBy(F.lit(0))
    total = F.sum("capacity").over(everything)
    wanted = F.call_function("div", total * share[0], F.lit(share[1] * epochs).cast("bigint"))
    parents: list[str] = []
    amounts = None
    for level, weight in zip(levels, weights):
        keys = [*parents, level]
        nodes = able.groupBy(*keys).agg(F.sum("capacity").alias("capacity"))
        if amounts is None:
            nodes = nodes.withColumn("amount", F.least(wanted, total))
        else:
            nodes = nodes.join(amounts, parents)
        shared = share_out(
            nodes.select(
                *keys,
                "capacity",
                "amount",
                _weight(F.col(level), weight).alias("weight"),
                F.col(level).alias("node"),
            ),
            parents,
        )
        amounts = shared.select(*keys, F.col("given").alias("amount"))
        parents = keys
    return leaves.join(amounts.withColumnRenamed("amount", "given"), levels)


def mix(
    df: DataFrame,
    levels: dict[str, Column],
    weights: dict[str, dict[str, int]],
    share: tuple[int, int],
    epochs: int = 2,
    seed: int = 1,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Select ``share`` (a fraction) of the words of ``df``, mixed to target weights.

    ``levels`` are the tree from the top down, ``weights`` whole positive numbers
    by level and value (1 where none is given; a null value is a node of its own).
    Returns the selected rows with all columns of ``df``, a row once for each epoch
    it is used in, and ``mix_<level>``, ``epoch``, ``n_tokens`` and ``taken_tokens``;
    where fewer tokens are taken than there are, ``text`` is cut to them. Tokens are words.
    Rows without words are never selected; rows equal in key and text follow one
    another. An empty table gives an empty one.
    """
    if any(w <= 0 or w != int(w) for by in weights.values() for w in by.values()):
        raise ValueError("weights must be whole positive numbers")
    names = [f"mix_{name}" for name in levels]
    made = {*names, "epoch", "n_tokens", "taken_tokens"}
    given = [c for c in df.columns if c.lower() not in made]
    # Under numbers, no name of the caller's can clash with those used here.
    held = {c: F.col(f"c{i}") for i, c in enumerate(given)}
    rows = df.select(
        *[quoted(c).alias(f"c{i}") for i, c in enumerate(given)],
        *[node_name(value).alias(name) for name, value in zip(names, levels.values())],
        count_words(quoted(text)).alias("n_tokens"),
    ).where("n_tokens > 0")
    # One pass over the texts; all that is counted afterwards is narrow.
    narrow = settle(
        rows.select(*names, "n_tokens", held[key].alias("key"), F.md5(held[text]).alias("tie")),
        "mix-rows",
    )
    leaves = settle(narrow.groupBy(*names).agg(F.sum("n_tokens").alias("tokens")), "mix-leaves")
    plan = settle(
        budgets(leaves, names, [weights.get(x, {}) for x in levels], share, epochs).select(
            *names,
            F.expr("given div tokens").alias("rounds"),
            F.expr("given % tokens").alias("rest"),
        ),
        "mix-plan",
    )
    at = _seeded(seed)
    placed = narrow.join(plan, names).select(*names, "n_tokens", "rest", at.alias("at"))
    edges = settle(_edges(placed, names), "mix-edges")

    chosen = (
        rows.withColumn("tie", F.md5(held[text]))
        .withColumn("key", held[key])
        .join(plan, names)
        .join(edges, names)
        .withColumn("at", at)
        .withColumn("slice", F.shiftright("at", BITS - SECOND))
    )
    clear = chosen.where("slice != edge").withColumn(
        "last_taken", F.when(F.col("slice") < F.col("edge"), F.col("n_tokens")).otherwise(0)
    )
    # The slice in which a leaf's budget ends: one row in 2**24 of the leaf.
    order = Window.partitionBy(*names).orderBy("at", "key", "tie")
    before = F.coalesce(
        F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    divided = chosen.where("slice = edge").withColumn(
        "last_taken",
        F.greatest(F.lit(0), F.least(F.col("n_tokens"), F.col("within") - before)),
    )
    uses = F.transform(
        F.sequence(F.lit(0), F.col("rounds").cast("int")),
        lambda e: F.struct(
            e.alias("epoch"),
            F.when(e < F.col("rounds"), F.col("n_tokens"))
            .otherwise(F.col("last_taken"))
            .cast("bigint")
            .alias("taken_tokens"),
        ),
    )
    used = clear.unionByName(divided).withColumn(
        "use", F.explode(F.filter(uses, lambda x: x["taken_tokens"] > 0))
    )
    cut = F.when(
        F.col("use.taken_tokens") < F.col("n_tokens"),
        first_words(held[text], F.col("use.taken_tokens")),
    ).otherwise(held[text])
    columns = [(cut if c == text else held[c]).alias(c) for c in given]
    values = [
        F.when(F.col(name) != "", F.substring(name, 2, 1 << 30)).alias(name) for name in names
    ]
    return used.select(*columns, *values, "use.epoch", "n_tokens", "use.taken_tokens")


def _seeded(seed: int) -> Column:
    """A whole number of 52 bits that orders rows anew for each seed and last epoch."""
    digest = F.md5(
        F.concat_ws(
            ":",
            F.lit(str(seed)),
            F.col("rounds").cast("string"),
            F.coalesce(F.col("key").cast("string"), F.lit("")),
            F.col("tie"),
        )
    )
    return F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("bigint")


def _edges(placed: DataFrame, names: list[str]) -> DataFrame:
    """For each leaf the slice of the order in which its budget ends, and what is left there.

    Two looks of 12 bits each: sums of a leaf's slices are all that meets in a task.
    """
    cut = placed.select(*names, F.lit(0).alias("edge"), F.col("rest").alias("within")).distinct()
    for bits in (FIRST, SECOND):
        here = F.shiftright("at", BITS - bits)
        outer = F.shiftright("at", BITS - bits + FIRST)
        inside = placed.join(cut, names).where(outer == F.col("edge"))
        sums = inside.groupBy(*names, "within", here.alias("slice")).agg(
            F.sum("n_tokens").alias("n")
        )
        order = Window.partitionBy(*names).orderBy("slice")
        running = F.coalesce(
            F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        )
        # The last slice that begins at or before the end of the budget.
        cut = (
            sums.withColumn("before", running)
            .where("before <= within")
            .groupBy(*names)
            .agg(F.max_by(F.struct("slice", (F.col("within") - F.col("before")).alias("left")), "slice").alias("x"))
            .select(*names, F.col("x.slice").alias("edge"), F.col("x.left").alias("within"))
        )
    return cut
