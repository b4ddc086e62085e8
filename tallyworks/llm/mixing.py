"""Mixing sources to target weights: a token budget handed down a tree, then prefixes of seeded epochs.

The budget goes from the root to domains, languages and sources. Among siblings
it is shared by weight; a child that cannot use its share (its documents times
the allowed epochs are fewer) gets what it can use and the rest goes to its
siblings by weight. Only what all siblings together cannot use is missing at
their parent, and so goes to the parent's siblings. Since every node's capacity is the
sum of its children's, handing down in this order does both at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyworks.llm.shared import discard, documents, written

LEVELS = ["domain", "lang", "source"]

# Weights of nodes by level; what is not named weighs 1.
WEIGHTS = {
    "domain": {"src0": 3.0},
    "lang": {"en": 4.0, "de": 2.0, "fr": 2.0},
    "source": {},
}
SHARE = 0.6        # of all tokens that the mixture shall have
EPOCHS = 3         # times that a document may be used
SEED = 17
SLICES = 4_096     # parts of a leaf's order that are summed before one of them is cut


def with_leaf(docs: DataFrame, tokens: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """The leaf of each document, and the columns ``keep``: its source's group is the domain. Null names count as ''."""
    source = F.coalesce("source", F.lit(""))
    return docs.select(
        "doc_id",
        F.when(source == "src0", "src0").otherwise("other").alias("domain"),
        F.coalesce("lang", F.lit("")).alias("lang"), source.alias("source"), tokens.cast("long").alias("tokens"),
        *keep,
    )


def _weight(level: str, weights: dict[str, dict[str, float]]) -> Column:
    out = F.lit(1.0)
    for name, weight in weights.get(level, {}).items():
        out = F.when(F.col(level) == name, F.lit(float(weight))).otherwise(out)
    return out


def _share(nodes: DataFrame, parent: list[str], level: str) -> DataFrame:
    """Split each parent's ``budget`` over its children by weight, none above its capacity.

    In order of capacity per weight the children fill up one after the other:
    a child is full if its capacity per weight is at most what the rest of
    the budget gives per weight to it and those after it.
    """
    siblings = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = siblings.orderBy(F.col("capacity") / F.col("weight"), level)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ranked = nodes.select(
        "*",
        F.coalesce(F.sum("capacity").over(before), F.lit(0)).alias("_used"),
        (F.sum("weight").over(siblings) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("_weights"),
    )
    rate = (F.col("budget") - F.col("_used")) / F.col("_weights")
    full = ranked.withColumn("_rate", rate).withColumn("_full", F.col("capacity") / F.col("weight") <= F.col("_rate"))
    # the rate of the first child that is not full holds for all after it; later ones only fall
    level_rate = F.max(F.when(~F.col("_full"), F.col("_rate"))).over(siblings)
    return full.withColumn("_level", level_rate).withColumn(
        "budget", F.when(F.col("_full"), F.col("capacity").cast("double"))
        .otherwise(F.least(F.col("_level") * F.col("weight"), F.col("capacity").cast("double")))
    ).drop("_used", "_weights", "_rate", "_full", "_level")


def budgets(
    leaves: DataFrame, weights: dict[str, dict[str, float]] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS
) -> DataFrame:
    """``(domain, lang, source, tokens, target)`` of ``leaves(domain, lang, source, tokens)``.

    ``target`` is in whole tokens, never more than ``epochs`` times the leaf's.
    """
    given = leaves.where("tokens > 0").withColumn("capacity", F.col("tokens") * epochs)
    total = given.agg(F.floor(F.sum("tokens") * F.lit(share)).cast("double").alias("budget"))
    nodes = None
    for depth, level in enumerate(LEVELS):
        path = LEVELS[:depth + 1]
        own = given.groupBy(*path).agg(F.sum("capacity").alias("capacity")).withColumn("weight", _weight(level, weights))
        if nodes is None:
            own = own.withColumn("budget", total.scalar())
        else:
            own = own.join(nodes.select(*path[:-1], "budget"), path[:-1])
        nodes = _share(own, path[:-1], level).select(*path, "budget")
    return given.join(nodes, LEVELS).select(*LEVELS, "tokens", F.floor(F.col("budget") + 1e-6).cast("long").alias("target"))


def mix(
    docs: DataFrame,
    weights: dict[str, dict[str, float]] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    seed: int = SEED,
    slices: int = SLICES,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``(doc_id, domain, lang, source, tokens, times)``: the documents of the mixture and how often each is used.

    ``docs`` has ``doc_id, domain, lang, source, tokens``; see ``with_leaf``. A leaf's epochs are
    orders of its documents drawn with the seed; the leaf gets the longest prefix
    of all its epochs, one after the other, within its target. Documents without tokens
    are not used. Equal texts and repeated rows are separate documents as long as
    their ids differ; rows of one id share its place in the order. The columns ``keep`` stay beside a row;
    rows without an id are placed, and rows of one id ordered, by them. An empty table
    gives an empty result.

    The prefix is found without sorting a leaf: the order is cut into slices by its
    hash, slices are summed, and only the slice where the target falls is summed
    row by row. A leaf that holds most rows is spread over all its slices.
    """
    ranked = docs.where("tokens > 0").withColumn("_at", F.lit(0))
    leaves = ranked.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    plan = budgets(leaves, weights, share, epochs).select(
        *LEVELS, F.floor(F.col("target") / F.col("tokens")).cast("int").alias("_whole"),
        (F.col("target") % F.col("tokens")).alias("_rest"),
    )
    drawn = ranked.drop("_at").join(plan, LEVELS)
    name = F.coalesce(F.col("doc_id").cast("string"), *([F.xxhash64(*keep).cast("string")] if keep else []))
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_whole").cast("string"), name))
    drawn = drawn.withColumn("_order", order).withColumn(
        "_slice", F.conv(F.left("_order", F.lit(8)), 16, 10).cast("long") % slices
    )
    sums = drawn.groupBy(*LEVELS, "_slice").agg(F.sum("tokens").alias("_n"))
    before = Window.partitionBy(*LEVELS).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*LEVELS, "_slice", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = drawn.join(sums, [*LEVELS, "_slice"])
    inside = placed.where("_before + _n <= _rest").withColumn("_more", F.lit(1))
    beyond = placed.where("_before >= _rest").withColumn("_more", F.lit(0))
    rows = Window.partitionBy(*LEVELS, "_slice").orderBy("_order", "doc_id", *keep).rowsBetween(Window.unboundedPreceding, 0)
    cut = placed.where("_before < _rest AND _before + _n > _rest").withColumn(
        "_more", (F.col("_before") + F.sum("tokens").over(rows) <= F.col("_rest")).cast("int")
    )
    return inside.unionByName(beyond).unionByName(cut).select(
        "doc_id", *LEVELS, "tokens", (F.col("_whole") + F.col("_more")).cast("int").alias("times"), *keep
    ).where("times > 0")


def choose(
    docs: DataFrame,
    tokens: Column,
    weights: dict[str, dict[str, float]] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    seed: int = SEED,
    slices: int = SLICES,
) -> DataFrame:
    """The rows of ``docs`` that the mixture uses, each as often as it is used; columns as given.

    The mixture is that of ``mix``. It is decided on leaf, tokens and order alone, as one
    cut-off in the order of each leaf, and rows are then held against their leaf's
    cut-off, so that no text is shuffled. Rows without an id are placed, and rows of one id ordered, by a hash of
    the row; rows equal in every column are used together or not at all. Rows without tokens are not used.
    An empty table gives an empty result.
    """
    whole = with_leaf(docs.withColumn("_row", F.struct(*docs.columns)), tokens, ("_row",)).where("tokens > 0")
    digest = F.xxhash64("_row")
    rows = whole.select(
        *LEVELS, "tokens", F.coalesce(F.col("doc_id").cast("string"), digest.cast("string")).alias("_name"),
        digest.alias("_digest"), "_row",
    )
    names = written(rows.drop("_row"), "mixture-names")
    leaves = names.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    plan = written(budgets(leaves, weights, share, epochs).select(
        *LEVELS, F.floor(F.col("target") / F.col("tokens")).cast("int").alias("_whole"),
        (F.col("target") % F.col("tokens")).alias("_rest"),
    ), "mixture-plan")
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_whole").cast("string"), F.col("_name")))
    ordered = lambda frame: frame.withColumn("_order", order).withColumn(
        "_slice", F.conv(F.left("_order", F.lit(8)), 16, 10).cast("long") % slices
    )
    drawn = ordered(names.join(plan, LEVELS))
    before = Window.partitionBy(*LEVELS).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = drawn.groupBy(*LEVELS, "_whole", "_rest", "_slice").agg(F.sum("tokens").alias("_n"))
    # what is left after whole epochs is less than the leaf, so it ends in one of its slices
    last = (
        sums.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .where("_before <= _rest AND _rest < _before + _n")
        .select(*LEVELS, F.col("_slice").alias("_last"), "_before")
    )
    # equal rows share an end of the running sum
    upto = Window.partitionBy(*LEVELS).orderBy("_order", "_digest").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inside = (
        drawn.join(last, LEVELS).where("_slice = _last")
        .withColumn("_upto", F.col("_before") + F.sum("tokens").over(upto))
    )
    cuts = written(inside.groupBy(*LEVELS, "_whole", "_last").agg(
        F.max(F.when(F.col("_upto") <= F.col("_rest"), F.struct("_order", "_digest"))).alias("_cut")
    ), "mixture-cuts")
    discard(names)
    more = (F.col("_slice") < F.col("_last")) | (
        (F.col("_slice") == F.col("_last"))
        & F.coalesce(F.struct("_order", "_digest") <= F.col("_cut"), F.lit(False))
    )
    used = ordered(rows.join(cuts, LEVELS)).withColumn("_times", F.col("_whole") + more.cast("int")).where("_times > 0")
    return used.select("_row", F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("_epoch")).select("_row.*")


def words(column: str) -> Column:
    """The number of words of a text, as its tokens."""
    return F.size(F.filter(F.split(F.coalesce(column, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != ""))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(with_leaf(documents(spark, folder), words("text")))


def _shared_sql(name: str, parent: list[str], level: str, budget: str) -> str:
    """One level of the tree: ``nodes`` in, ``name`` out. A child fills up to its capacity or to its weight times a rate,
    the least rate at which the siblings together take the whole budget."""
    on = " AND ".join(f"n.{p} = b.{p}" for p in parent) or "true"
    path = ", ".join(f"n.{p}" for p in [*parent, level])
    group = ", ".join([*parent, level])
    weight = " ".join(f"WHEN {level} = '{k}' THEN {v}" for k, v in WEIGHTS[level].items())
    weight = f"CASE {weight} ELSE 1.0 END" if weight else "1.0"
    same = " AND ".join(f"a.{p} = c.{p}" for p in parent) or "true"
    return f"""
    {name}_n AS (SELECT {group}, sum(capacity) AS capacity, {weight} AS weight FROM leaves GROUP BY {group}),
    {name}_b AS (SELECT {path}, n.capacity, n.weight, b.budget FROM {name}_n n JOIN {budget} b ON {on}),
    -- what the siblings take at the rate at which each of them becomes full
    {name}_r AS (SELECT {", ".join(f"c.{p}" for p in [*parent, level])}, c.capacity, c.weight, c.budget, c.capacity / c.weight AS own,
        sum(least(a.capacity, a.weight * (c.capacity / c.weight))) AS taken,
        sum(CASE WHEN a.capacity / a.weight < c.capacity / c.weight THEN a.capacity ELSE 0 END) AS below,
        sum(CASE WHEN a.capacity / a.weight < c.capacity / c.weight THEN 0 ELSE a.weight END) AS open
        FROM {name}_b c JOIN {name}_b a ON {same} GROUP BY ALL),
    {name}_l AS (SELECT {", ".join(parent) + ", " if parent else ""}max(CASE WHEN taken > budget THEN (budget - below) / open END) AS rate FROM {name}_r {"GROUP BY " + ", ".join(parent) if parent else ""}),
    {name} AS (SELECT {path}, least(n.capacity, coalesce(n.weight * b.rate, n.capacity)) AS budget
        FROM {name}_b n JOIN {name}_l b ON {on})"""


def mixing_sql() -> str:
    """The same mixture in SQL: the budget by rates, the prefix by a running sum over each leaf."""
    return f"""
    WITH docs AS (
        SELECT doc_id, CASE WHEN coalesce(source, '') = 'src0' THEN 'src0' ELSE 'other' END AS domain,
            coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) AS tokens
        FROM documents),
    leaves AS (SELECT domain, lang, source, sum(tokens) AS tokens, CAST(sum(tokens) * {EPOCHS} AS DOUBLE) AS capacity
        FROM docs WHERE tokens > 0 GROUP BY ALL),
    root AS (SELECT floor(sum(tokens) * {SHARE}) AS budget FROM leaves),
    {_shared_sql("d", [], "domain", "root")},
    {_shared_sql("l", ["domain"], "lang", "d")},
    {_shared_sql("s", ["domain", "lang"], "source", "l")},
    plan AS (SELECT domain, lang, source, tokens AS leaf, CAST(floor(budget + 1e-6) AS BIGINT) AS target
        FROM leaves JOIN s USING (domain, lang, source)),
    drawn AS (SELECT doc_id, domain, lang, source, tokens, CAST(target // leaf AS BIGINT) AS whole, target % leaf AS rest,
        md5('{SEED}:' || (target // leaf) || ':' || doc_id) AS ordered
        FROM docs JOIN plan USING (domain, lang, source) WHERE tokens > 0),
    summed AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source
        ORDER BY CAST('0x' || left(ordered, 8) AS BIGINT) % {SLICES}, ordered, doc_id
        ROWS UNBOUNDED PRECEDING) AS upto FROM drawn)
    SELECT doc_id, domain, lang, source, CAST(tokens AS BIGINT) AS tokens,
        CAST(whole + CASE WHEN upto <= rest THEN 1 ELSE 0 END AS INTEGER) AS times
    FROM summed WHERE whole + CASE WHEN upto <= rest THEN 1 ELSE 0 END > 0"""
