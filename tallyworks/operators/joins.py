"""Inner joins on shared keys that hold up when a few keys own most of the rows."""

from __future__ import annotations

from functools import reduce
from math import prod

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.sinks import tables

# Rows that a join may make of one key in one task.
HOT_ROWS = 2_000_000
# Keys that are split at most. A key beyond them has at most that share of all rows the join makes.
MOST_HOT = 10_000
LEAST_BUCKETS, MOST_BUCKETS = 1 << 10, 1 << 24


def maybe_hot(frames: list[DataFrame], keys: list[str], hot_rows: int = HOT_ROWS) -> list[DataFrame]:
    """The keys of each frame, without most of those that ``hot_keys`` cannot list; the frames must be tables, as they are read twice.

    Keys are counted by buckets of their hash first, which tasks add up before the shuffle: a bucket has at
    least the rows of each of its keys in every frame. Only keys of buckets whose rows multiply to more than ``hot_rows``
    are left. There are as many buckets as let an eighth of ``hot_rows`` fall on each if no key is hot.
    """
    wanted = (8 * prod(frame.count() for frame in frames) / max(hot_rows, 1)) ** (1 / len(frames))
    buckets = min(max(1 << int(wanted).bit_length(), LEAST_BUCKETS), MOST_BUCKETS)
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    bucket = F.xxhash64(*keys).bitwiseAND(F.lit(buckets - 1)).alias("_bucket")
    dealt = [frame.where(present).select(*keys, bucket) for frame in frames]
    tagged = [frame.select("_bucket", F.lit(i).alias("_frame")) for i, frame in enumerate(dealt)]
    counted = reduce(DataFrame.unionByName, tagged).groupBy("_bucket").agg(
        *[F.count_if(F.col("_frame") == i).cast("double").alias(f"_n{i}") for i in range(len(frames))]
    )
    rows = reduce(lambda a, b: a * b, [F.col(f"_n{i}") for i in range(len(frames))])
    crowded = tables.scratch(counted.where(rows > hot_rows).select("_bucket"), "crowded-buckets")
    return [frame.join(crowded, "_bucket", "left_semi").drop("_bucket") for frame in dealt]


def hot_keys(frames: list[DataFrame], keys: list[str], hot_rows: int = HOT_ROWS, most: int = MOST_HOT) -> DataFrame:
    """``(*keys, split, salts)``: every key whose join has more than ``hot_rows`` rows, the ``most`` largest of them.

    What counts is the product of a key's rows over the frames, so a key that is
    moderate in each of them is found too. ``split`` is the frame with most of its
    rows, ``salts`` the number of parts that it is cut into: as many as needed, no more than
    it has rows. A key that is null, or lacks in one frame, joins nothing and is not listed.

    The bound makes the list safe to broadcast. It costs nothing in balance: of ``most`` + 1 keys
    the smallest has less than a ``most``-th of the rows.
    """
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    tagged = [frame.select(*keys, F.lit(i).alias("_frame")).where(present) for i, frame in enumerate(frames)]
    counted = reduce(DataFrame.unionByName, tagged).groupBy(*keys).agg(
        *[F.count_if(F.col("_frame") == i).alias(f"_n{i}") for i in range(len(frames))]
    )
    counts = [F.col(f"_n{i}") for i in range(len(frames))]
    rows = reduce(lambda a, b: a * b, [c.cast("double") for c in counts])
    largest = F.greatest(*counts)
    return counted.where(rows > hot_rows).orderBy(rows.desc(), *keys).limit(most).select(
        *keys,
        (F.array_position(F.array(*counts), largest) - 1).cast("int").alias("split"),
        F.least(F.ceil(rows / hot_rows), largest.cast("double")).cast("int").alias("salts"),
    )


def salted_inner_join(frames: list[DataFrame], keys: list[str], spread: list[str], hot: DataFrame) -> DataFrame:
    """Inner join of several frames on the same key columns, hot keys spread over many tasks.

    A row of a hot key takes a salt from its frame's ``spread`` column if that
    frame is the one to split, and is repeated once per salt in the others. All
    frames then join on keys and salt together, so each combination of rows meets
    once, all joins share one partitioning, and keys that are not hot are left as they
    are. A row is never repeated more often than the join would return it. Which keys
    count as hot decides about speed only: ``hot`` may come from the frames before
    they were filtered.

    Rows learn their salt before any shuffle on the key: ``hot`` has a bounded number of rows
    (see ``hot_keys``), so it is sent to every task.

    ``spread`` names one integer column per frame, dropped from the result. A
    task that is run again must find the same value for the same row, so derive
    it from the row's content, or number the rows directly on a file scan;
    never number rows that come out of a shuffle.

    Frames must not share columns other than the keys.
    """
    salted = []
    for i, frame in enumerate(frames):
        own = F.array(F.pmod(F.col(spread[i]), F.col("salts")).cast("int"))
        every = F.sequence(F.lit(0), F.col("salts") - 1)
        salt = F.when(F.col("salts").isNull(), F.array(F.lit(0))).when(F.col("split") == i, own).otherwise(every)
        salted.append(
            frame.join(F.broadcast(hot), keys, "left")
            .withColumn("_salt", F.explode(salt)).drop("split", "salts", spread[i])
        )
    return reduce(lambda a, b: a.join(b, [*keys, "_salt"], "inner"), salted).drop("_salt")
