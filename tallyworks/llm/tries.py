"""Prefix trie of rebuilt conversations, from fingerprints that are composed instead of texts that are copied.

The fingerprint of a sequence of turns t1 … td is the sum of ``code(t_j) * B^j`` in several prime
fields. It is a monoid product: a sequence put behind another one of n turns adds its own
sum times ``B^n``. So a rebuilt conversation, a head taken from its base and its own turns from the h-th on, is never
formed. The prefix of depth d is the base's sum up to its head, and beyond it a constant plus a
factor times the own sum, where both depend on the conversation alone.

Prefixes with equal depth and fingerprint are one node. Members keep a reference to their last turn, the SHA-256 of its
role and text: a node whose members differ in that, or in the node above, would be a collision, and
then all is done again with other bases.

No step brings a conversation, a node's members or its children together in one task. Turns are
numbered and summed in blocks of turn numbers, and block sums carried on; nodes are counted before
the shuffle; ids for the digests travel in parts.

Sums over subtrees follow chains. A node is named after its smallest member, so the nodes of one
name lie below one another on one path: a chain, hanging on a node of another chain. Totals are
handed from chain to chain in as many rounds as chains hang on chains, then summed along each chain.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyworks.llm.mixing import words
from tallyworks.llm.shared import written
from tallyworks.operators.joins import hot_keys, salted_inner_join

BASE_EVERY = 20          # conversations that share a base
HEADS = 4                # a head has fewer turns than this
TURNS_A_BLOCK = 256
DEPTHS_A_BLOCK = 4_096
IDS_A_PART = 4_096
PRIME = (1 << 31) - 1
LANES = 4
_FIELDS = [f"f{k}" for k in range(LANES)]     # a prefix
_ABOVE = [f"q{k}" for k in range(LANES)]      # the prefix one turn shorter


def _bases(seed: int) -> list[int]:
    """One base for each lane, drawn with the seed."""
    drawn = (int.from_bytes(hashlib.sha256(f"{seed}:{k}".encode()).digest()[:8], "big") for k in range(LANES))
    return [1_000_003 + n % (PRIME - 2_000_006) for n in drawn]


def _power(base: int, exponent: Column) -> Column:
    """``base ** exponent`` in the field, for exponents below 2^31."""
    out = F.lit(1).cast("long")
    for bit in range(31):
        factor = F.when(F.shiftright(exponent, bit).bitwiseAND(F.lit(1)) == 1, F.lit(pow(base, 1 << bit, PRIME))).otherwise(F.lit(1))
        out = out * factor % PRIME
    return out


def _head_turns(conv: Column) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % HEADS


def _numbered_turns(conversations: DataFrame, bases: list[int]) -> tuple[DataFrame, DataFrame]:
    """Turns ``(conv, block, i, ref, n_words, l*, p*)`` with sums within a block up to a turn and before it,
    and blocks ``(conv, block, start, n, c*)`` with the turns and the sum before the block."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("turn"),
        F.floor(F.col("turn") / TURNS_A_BLOCK).cast("long").alias("block"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)).alias("ref"),
        words("text").cast("long").alias("n_words"),
    )
    inside = Window.partitionBy("conv", "block").orderBy(F.asc_nulls_first("turn"), "ref")
    upto, before = inside.rowsBetween(Window.unboundedPreceding, 0), inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = turns.withColumn("i", F.row_number().over(inside).cast("long"))
    coded = placed.withColumns({
        f"t{k}": F.pmod(F.xxhash64("ref", F.lit(k)), F.lit(PRIME)) * _power(base, F.col("i")) % PRIME
        for k, base in enumerate(bases)
    })
    summed = written(coded.select(
        "conv", "block", "i", "ref", "n_words",
        *[(F.sum(f"t{k}").over(upto) % PRIME).alias(f"l{k}") for k in range(LANES)],
        *[F.coalesce(F.sum(f"t{k}").over(before) % PRIME, F.lit(0)).alias(f"p{k}") for k in range(LANES)],
    ), "trie-turns")
    last = summed.groupBy("conv", "block").agg(
        F.max("i").alias("n"), F.max_by(F.struct(*[f"l{k}" for k in range(LANES)]), "i").alias("l")
    )
    earlier = Window.partitionBy("conv").orderBy(F.asc_nulls_first("block")).rowsBetween(Window.unboundedPreceding, -1)
    started = last.withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    blocks = started.select("conv", "block", "n", "start", *[
        F.coalesce(F.sum(F.col("l")[f"l{k}"] * _power(base, F.col("start")) % PRIME).over(earlier) % PRIME, F.lit(0)).alias(f"c{k}")
        for k, base in enumerate(bases)
    ])
    return summed, written(blocks, "trie-blocks")


def _same_block(a: DataFrame, b: DataFrame):
    return (a["conv"] == b["conv"]) & a["block"].eqNullSafe(b["block"])


def _prefixes(conversations: DataFrame, seed: int) -> DataFrame:
    """``(conv, d, ends, ref, n_words, f*, q*)``: every prefix of every rebuilt conversation, the empty one included."""
    bases = _bases(seed)
    turns, blocks = _numbered_turns(conversations, bases)
    lengths = blocks.groupBy("conv").agg(F.sum("n").alias("n"))
    first = blocks.where(F.col("start") < HEADS - 1).alias("b")
    few = turns.where(F.col("i") < HEADS).alias("t")
    heads = written(
        few.join(first, _same_block(few, first)).where(F.col("start") + F.col("i") < HEADS).select(
            F.col("t.conv").alias("base"), (F.col("start") + F.col("i")).alias("j"), "ref", "n_words",
            *[((F.col(f"c{k}") + _power(b, F.col("start")) * F.col(f"l{k}")) % PRIME).alias(f"f{k}") for k, b in enumerate(bases)],
            *[((F.col(f"c{k}") + _power(b, F.col("start")) * F.col(f"p{k}")) % PRIME).alias(f"q{k}") for k, b in enumerate(bases)],
        ), "trie-heads")

    def sums(name: str) -> DataFrame:
        return heads.select(F.col("base").alias(f"{name}_conv"), F.col("j").alias(f"{name}_j"), F.struct(*_FIELDS).alias(name))

    plan = lengths.select("conv", "n", _head_turns(F.col("conv")).alias("h"), (F.col("conv") - F.col("conv") % BASE_EVERY).alias("base"))
    base_lengths = lengths.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    plan = plan.join(base_lengths, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    plan = plan.join(sums("head"), (F.col("base") == F.col("head_conv")) & (F.col("taken") == F.col("head_j")), "left")
    plan = plan.join(sums("own"), (F.col("conv") == F.col("own_conv")) & (F.col("h") == F.col("own_j")), "left")
    plan = written(plan.select(
        "conv", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("size"), "head", "own"
    ), "trie-plan")

    root = plan.select(
        "conv", F.lit(0).cast("long").alias("d"), (F.col("size") == 0).alias("ends"), F.lit(b"").alias("ref"),
        F.lit(0).cast("long").alias("n_words"), *[F.lit(0).cast("long").alias(c) for c in [*_FIELDS, *_ABOVE]],
    )
    taken = plan.select("conv", "base", "taken", "size").where("taken > 0").join(heads, "base").where("j <= taken").select(
        "conv", F.col("j").alias("d"), (F.col("size") == F.col("j")).alias("ends"), "ref", "n_words", *_FIELDS, *_ABOVE
    )
    # what stands before an own turn, as one constant and one factor for each block
    shift = F.col("taken") - F.col("h")
    composed = {}
    for k, b in enumerate(bases):
        back = reduce(
            lambda c, s: F.when(shift == -s, F.lit(pow(b, -s, PRIME))).otherwise(c), range(1, HEADS), F.lit(1).cast("long")
        )
        head, own = F.coalesce(F.col("head")[f"f{k}"], F.lit(0)), F.coalesce(F.col("own")[f"f{k}"], F.lit(0))
        composed[f"constant{k}"] = (head + back * F.pmod(F.col(f"c{k}") - own, F.lit(PRIME))) % PRIME
        composed[f"factor{k}"] = back * _power(b, F.col("start")) % PRIME
    carried = blocks.join(plan.where("size > taken"), "conv").where(F.col("start") + F.col("n") > F.col("h")).select(
        "conv", "block", (F.col("start") - F.col("h")).alias("skip"), (F.col("start") + shift).alias("moved"), "size",
        *[c.alias(name) for name, c in composed.items()],
    ).alias("c")
    t = turns.alias("t")
    depth = F.col("i") + F.col("moved")
    rest = t.join(carried, _same_block(t, carried)).where("i + skip > 0").select(
        F.col("t.conv").alias("conv"), depth.alias("d"), (F.col("size") == depth).alias("ends"), "ref", "n_words",
        *[((F.col(f"constant{k}") + F.col(f"factor{k}") * F.col(f"l{k}")) % PRIME).alias(f"f{k}") for k in range(LANES)],
        *[((F.col(f"constant{k}") + F.col(f"factor{k}") * F.col(f"p{k}")) % PRIME).alias(f"q{k}") for k in range(LANES)],
    )
    return written(root.unionByName(taken).unionByName(rest), "trie-prefixes")


def _nodes(prefixes: DataFrame) -> tuple[DataFrame, int]:
    """``(d, f*, q*, conv_id, n_convs, saved)`` and the number of nodes that join different prefixes."""
    same = F.lit(True)
    for c in ["ref", *_ABOVE]:
        same = same & (F.min(c) == F.max(c))
    nodes = written(prefixes.groupBy("d", *_FIELDS).agg(
        F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        *[F.min(c).alias(c) for c in _ABOVE], ((F.count(F.lit(1)) - 1) * F.max("n_words")).alias("saved"), same.alias("same"),
    ), "trie-nodes")
    return nodes.drop("same"), nodes.where("NOT same").count()


def _chains(nodes: DataFrame) -> DataFrame:
    """``(conv_id, top, bottom, saved, above, at)``: each chain, and the chain and depth at which it hangs (none for the root's)."""
    chains = nodes.groupBy("conv_id").agg(
        F.min("d").alias("top"), F.max("d").alias("bottom"), F.sum("saved").alias("saved"),
        F.min_by(F.struct(*_ABOVE), "d").alias("q"),
    )
    keys = ["at", *_FIELDS]
    hanging = chains.where("top > 0").select(
        (F.col("top") - 1).alias("at"), *[F.col("q")[f"q{k}"].alias(f"f{k}") for k in range(LANES)],
        "conv_id", "top", "bottom", "saved", F.col("conv_id").alias("_row"),
    )
    parents = nodes.select(F.col("d").alias("at"), *_FIELDS, F.col("conv_id").alias("above"), F.lit(0).alias("_one"))
    placed = salted_inner_join([hanging, parents], keys, ["_row", "_one"], hot_keys([hanging, parents], keys))
    none = F.lit(None).cast("long")
    return written(
        placed.select("conv_id", "top", "bottom", "saved", "above", "at").unionByName(
            chains.where("top = 0").select("conv_id", "top", "bottom", "saved", none.alias("above"), none.alias("at"))
        ), "trie-chains")


def _handed_on(chains: DataFrame, own_leaf: DataFrame) -> DataFrame:
    """``(conv_id, d, saved, leaves)``: what the chains that hang at a node hold, all chains on them included."""
    handed = chains.where("above IS NOT NULL").join(own_leaf, "conv_id").groupBy(
        F.col("above").alias("conv_id"), F.col("at").alias("d")
    ).agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaves"))
    rounds = [written(handed, "trie-round")]
    hung = chains.where("above IS NOT NULL").select("conv_id", "above", "at")
    while True:
        upward = rounds[-1].groupBy("conv_id").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
        upward = written(upward.join(hung, "conv_id").groupBy(F.col("above").alias("conv_id"), F.col("at").alias("d")).agg(
            F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")
        ), "trie-round")
        if upward.isEmpty():
            break
        rounds.append(upward)
    return reduce(DataFrame.unionByName, rounds).groupBy("conv_id", "d").agg(
        F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")
    )


def _digests(batches):
    """``(conv_id, d, ends_sha256)`` of parts ``(conv_id, d, part, ids)`` that come in order."""
    at, digest = None, None

    def done():
        return pa.RecordBatch.from_pydict({
            "conv_id": pa.array([at[0]], pa.int64()), "d": pa.array([at[1]], pa.int64()), "ends_sha256": [digest.hexdigest()]
        })

    for batch in batches:
        for conv, d, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist()):
            if (conv, d) != at:
                if at is not None:
                    yield done()
                at, digest = (conv, d), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
    if at is not None:
        yield done()


def _ends(prefixes: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(conv_id, d, ends_sha256)``: the digest of the conversations that end at a node, where there are any."""
    part = F.floor(F.col("conv") / IDS_A_PART).cast("long")
    parts = prefixes.where("ends").groupBy("d", *_FIELDS, part.alias("part")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids")
    )
    named = parts.join(nodes.select("d", *_FIELDS, "conv_id"), ["d", *_FIELDS]).select("conv_id", "d", "part", "ids")
    return named.repartition("conv_id", "d").sortWithinPartitions("conv_id", "d", "part").mapInArrow(
        _digests, "conv_id long, d long, ends_sha256 string"
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``.

    ``conversations`` has ``conv_id, turn, role, text``; other columns are not read. Turns are ordered by number, those without one
    first; turns of equal number by the SHA-256 of ``length(role):role`` and text. A missing role or text is an
    empty one. The base of conversation ``c`` is ``c - c % 20``, with the sign that SQL gives a remainder. Rows without a ``conv_id`` belong to no conversation and are left out. Repeated rows are
    repeated turns. An empty table has no conversations and gives no node, not even a root.
    """
    for seed in range(8):
        prefixes = _prefixes(conversations, seed)
        nodes, mixed = _nodes(prefixes)
        if not mixed:
            break
    else:
        raise RuntimeError("prefixes could not be told apart by fingerprints of eight seeds")
    chains = _chains(nodes)
    hanging = chains.where("above IS NOT NULL").groupBy(F.col("above").alias("conv_id"), F.col("at").alias("d")).agg(
        F.count(F.lit(1)).alias("hung")
    )
    bottoms = chains.select("conv_id", F.col("bottom").alias("d")).join(hanging, ["conv_id", "d"], "left")
    own_leaf = bottoms.select("conv_id", F.col("hung").isNull().cast("long").alias("leaf"))
    handed = _handed_on(chains, own_leaf).withColumnRenamed("saved", "more")

    at = ["conv_id", "d"]
    ends = _ends(prefixes, nodes)
    # a chain's nodes in blocks of depth, summed from the bottom up
    tops = chains.select("conv_id", "top", "bottom", "above")
    deep = nodes.select(*at, "n_convs", "saved").join(hanging, at, "left").join(handed, at, "left").withColumns({
        "block": F.floor(F.col("d") / DEPTHS_A_BLOCK), "saved": F.col("saved") + F.coalesce("more", F.lit(0)),
        "leaves": F.coalesce("leaves", F.lit(0)), "hung": F.coalesce("hung", F.lit(0)),
    })
    deep = written(deep.drop("more"), "trie-deep")
    sums = deep.groupBy("conv_id", "block").agg(F.sum("saved").alias("s"), F.sum("leaves").alias("l"), F.max("d").alias("low"))
    below = Window.partitionBy("conv_id").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.join(tops, "conv_id").join(own_leaf, "conv_id").select(
        "conv_id", "block", "top", "bottom", "above",
        F.coalesce(F.sum("s").over(below), F.lit(0)).alias("s"), (F.coalesce(F.sum("l").over(below), F.lit(0)) + F.col("leaf")).alias("l"),
    )
    inside = Window.partitionBy("conv_id", "block").orderBy(F.desc("d")).rowsBetween(Window.unboundedPreceding, 0)
    found = deep.withColumns({"saved": F.sum("saved").over(inside), "leaves": F.sum("leaves").over(inside)}).join(
        carried, ["conv_id", "block"]
    )
    nothing = hashlib.sha256(b"").hexdigest()
    return found.join(ends, at, "left").select(
        "conv_id", F.col("d").alias("depth"),
        F.when(F.col("d") == 0, None).when(F.col("d") > F.col("top"), F.col("conv_id")).otherwise(F.col("above")).alias("parent_conv_id"),
        "n_convs", ((F.col("d") < F.col("bottom")).cast("long") + F.col("hung")).alias("n_children"),
        (F.col("leaves") + F.col("l")).alias("n_leaves"), (F.col("saved") + F.col("s")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The trie of all rebuilt conversations."""
    return prefix_trie(spark.read.parquet(f"{folder}/conversations.parquet"))


def trie_sql() -> str:
    """The same trie from rebuilt lists: a prefix is a slice of a list, and a node's subtree all that starts with it."""
    # CRC-32 bit by bit: 3988292384 is the reversed polynomial
    bits = "list_reduce([xor(crc, code)] || range(8), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))"
    crc = f"xor(list_reduce([4294967295::BIGINT] || codes, lambda crc, code: {bits}), 4294967295)"
    return rf"""
    WITH own AS (SELECT conv_id AS c, list(t ORDER BY turn NULLS FIRST, ref) AS ts FROM (SELECT conv_id, turn,
            sha256(len(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS ref,
            (ref, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT)) AS t
            FROM conversations WHERE conv_id IS NOT NULL) GROUP BY conv_id),
    heads AS (SELECT c, ts, {crc} % 4 AS h FROM (SELECT c, ts,
            list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS codes FROM own)),
    rebuilt AS (SELECT a.c, list_concat(coalesce(b.ts, [])[1:CAST(a.h AS INTEGER)], a.ts[CAST(a.h AS INTEGER) + 1:]) AS ts
        FROM heads a LEFT JOIN own b ON b.c = a.c - a.c % 20),
    prefixes AS (SELECT c, d, len(ts) AS size, CAST(ts[1:d] AS VARCHAR) AS path, ts[1:d] AS p
        FROM (SELECT c, ts, unnest(range(len(ts) + 1)) AS d FROM rebuilt)),
    nodes AS (SELECT path, d, any_value(p) AS p, min(c) AS conv_id, count(*) AS n,
        sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (size = d), '')) AS ends FROM prefixes GROUP BY path, d),
    named AS (SELECT *, CASE WHEN d > 0 THEN CAST(p[1:d - 1] AS VARCHAR) END AS up,
        (n - 1) * CASE WHEN d > 0 THEN p[d][2] ELSE 0 END AS saved FROM nodes),
    children AS (SELECT up, count(*) AS k FROM named GROUP BY up),
    under AS (SELECT CAST(p[1:e] AS VARCHAR) AS path, saved, CASE WHEN k IS NULL THEN 1 ELSE 0 END AS leaf
        FROM (SELECT v.p, v.saved, k, unnest(range(v.d + 1)) AS e FROM named v LEFT JOIN children x ON x.up = v.path)),
    totals AS (SELECT path, sum(saved) AS saved, sum(leaf) AS leaves FROM under GROUP BY path)
    SELECT v.conv_id, v.d AS depth, u.conv_id AS parent_conv_id, v.n AS n_convs, coalesce(k, 0) AS n_children,
        CAST(t.leaves AS BIGINT) AS n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens, v.ends AS ends_sha256
    FROM named v JOIN totals t USING (path) LEFT JOIN nodes u ON u.path = v.up LEFT JOIN children x ON x.up = v.path"""
