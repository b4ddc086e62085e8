"""Near-duplicate embeddings by a pivot-permutation index.

Every vector is described by its nearest reference points, in order. Two near
vectors have several of them in common, so the inverted lists are kept by sets of
``shared`` reference points: a pair that shares at least that many meets in a
list. It is verified by its cosine in the list of its smallest shared points
only, so it counts once however many lists it meets in.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm.shared import components, written
from tallyworks.llm.vectors import as_doubles, in_groups, matrix, runs, usable

PIVOTS = 64        # reference points; a set of them is one 64-bit number
NEAREST = 6        # reference points that describe a vector
SHARED = 3         # that a pair has in common to be compared
SAMPLE = 1_024     # vectors that the reference points are chosen from
BLOCK = 2_048      # vectors of a list compared with as many others in one task


def reference_points(vectors: DataFrame, pivots: int = PIVOTS, sample: int = SAMPLE) -> np.ndarray:
    """Unit vectors far from one another: each next one is the farthest of a bounded sample from those before."""
    rows = vectors.orderBy(F.xxhash64("vector"), "vector").limit(sample).select("vector").collect()
    found = np.array([row[0] for row in rows], dtype=np.float64)
    if not len(found):
        return found
    found /= np.linalg.norm(found, axis=1, keepdims=True)
    chosen, nearest = [0], found @ found[0]
    while len(chosen) < min(pivots, len(found)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, found @ found[chosen[-1]])
    return found[chosen]


def _describe(points: np.ndarray, nearest: int, shared: int):
    """Emit a posting for each set of ``shared`` among a vector's nearest reference points."""
    nearest = min(nearest, len(points))
    shared = min(shared, nearest)
    sets = np.array(list(combinations(range(nearest), shared)))
    bits = np.uint64(1) << np.arange(64, dtype=np.uint64)

    def describe(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = matrix(batch.column("vector"))
            unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
            order = np.argsort(-(unit @ points.T), axis=1, kind="stable")[:, :nearest]
            mask = np.bitwise_or.reduce(bits[order], axis=1)
            keys = np.bitwise_or.reduce(bits[order][:, sets], axis=2)
            rows = np.repeat(np.arange(len(vectors)), len(sets))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel().view(np.int64)), pa.array(mask.view(np.int64)[rows]),
                 *(batch.column(c).take(pa.array(rows)) for c in ("label", "size", "vec_id", "vector"))],
                names=["points", "mask", "label", "size", "vec_id", "vector"],
            )

    return describe


def _least_reachable(ids: np.ndarray, near: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest id that the links between ``a`` and ``b`` lead to, for each vector."""
    least = ids.copy()
    left, right = np.nonzero(near)
    left, right = a[left], b[right]
    while True:
        before = least.copy()
        np.minimum.at(least, left, before[right])
        np.minimum.at(least, right, before[left])
        if (least == before).all():
            return least


def _compare(threshold: float, shared: int):
    """In one pair of blocks of one list: count links, and name for each vector the least that they lead to."""

    def compare(batches):
        for table in runs(batches, ["label", "points", "left", "right"]):
            same = table["left"][0].as_py() == table["right"][0].as_py()
            first = table["is_left"].to_numpy(zero_copy_only=False).astype(bool)
            ids = table["vec_id"].to_numpy()
            size = table["size"].to_numpy()
            mask = table["mask"].to_numpy().view(np.uint64)
            unit = matrix(table["vector"])
            unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
            points = np.uint64(table["points"][0].as_py() & (2**64 - 1))
            below = np.uint64((1 << int(points).bit_length()) - 1)
            a, b = (np.arange(len(ids)),) * 2 if same else (np.flatnonzero(first), np.flatnonzero(~first))
            if not len(a) or not len(b):
                continue
            near = np.empty((len(a), len(b)), dtype=bool)
            for start in range(0, len(a), 256):
                part = a[start:start + 256]
                close = unit[part] @ unit[b].T >= threshold
                # the list of a pair's smallest shared reference points owns it
                close &= np.bitwise_count(mask[part][:, None] & mask[b][None, :] & below) == shared
                if same:
                    close &= part[:, None] != b[None, :]
                near[start:start + 256] = close
            links = np.zeros(len(ids), dtype=np.int64)
            links[a] = near @ size[b]
            if not same:
                links[b] = size[a] @ near
            least = _least_reachable(ids, near, a, b)
            linked = links > 0
            if linked.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[linked]), pa.array(links[linked]), pa.array(least[linked])],
                    names=["vec_id", "n", "least"],
                )

    return compare


def near_duplicates(
    embeddings: DataFrame,
    threshold: float = 0.93,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    nearest: int = NEAREST,
    shared: int = SHARED,
    block: int = BLOCK,
) -> DataFrame:
    """``(id, n_links, component_id, kept)`` for every row.

    Rows are linked if their labels are equal and not null and their cosine, in
    double precision, is at least ``threshold``. Rows whose label is null or whose
    vector is null, empty, zero or holds null or non-finite components stay alone.
    Vectors of different lengths are never linked. Exact copies are one entry of
    the index and count as their number. Ids must be distinct; other columns are
    not read. An empty table gives an empty result.

    ``component_id`` is the smallest id reachable by links, ``kept`` marks the
    rows that are it. Every link found is verified; a pair is missed only if it
    shares fewer than ``shared`` of its ``nearest`` reference points.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(label_column).cast("string").alias("label"),
        F.when(usable(vector_column), as_doubles(vector_column)).alias("vector"),
    )
    valid = rows.where("vector IS NOT NULL AND label IS NOT NULL").withColumn("length", F.size("vector"))
    # the copies of a vector: a class, counted before it is sent anywhere
    classes = written(
        valid.groupBy("label", "length", "vector").agg(F.min("vec_id").alias("vec_id"), F.count("vec_id").alias("size")),
        "vector-classes",
    )
    found = None
    # one index for each length of vector; embeddings of one model have one length
    for length in sorted(r[0] for r in classes.select("length").distinct().collect()):
        own = classes.where(F.col("length") == length)
        points = reference_points(own)
        postings = own.select("label", "size", "vec_id", "vector").mapInArrow(
            _describe(points, nearest, shared),
            "points long, mask long, label string, size long, vec_id long, vector array<double>",
        )
        # lists with one vector compare nothing; long ones are cut into blocks
        lists = postings.groupBy("label", "points").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        blocks = F.ceil(F.col("n") / block).cast("int")
        mine = F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")
        dealt = (
            postings.join(lists, ["label", "points"])
            .withColumn("blocks", blocks).withColumn("mine", mine)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select(
                "label", "points", F.least("mine", "other").alias("left"), F.greatest("mine", "other").alias("right"),
                (F.col("mine") <= F.col("other")).alias("is_left"), "vec_id", "size", "mask", "vector",
            )
        )
        own_shared = min(shared, nearest, len(points))
        pairs = in_groups(dealt, ["label", "points", "left", "right"], ["vec_id"]).mapInArrow(
            _compare(threshold, own_shared), "vec_id long, n long, least long"
        )
        found = pairs if found is None else found.unionByName(pairs)
    if found is None:
        found = spark.createDataFrame([], "vec_id long, n long, least long")
    found = written(found.groupBy("vec_id", "least").agg(F.sum("n").alias("n")), "vector-links")
    parts = components(
        found.select(F.col("vec_id").alias("a"), F.col("least").alias("b")), "vector-components"
    )
    counted = found.groupBy("vec_id").agg(F.sum("n").alias("n"))
    classes = (
        classes.join(counted, "vec_id", "left")
        .join(parts, F.col("vec_id") == F.col("node"), "left")
        .select(
            "label", "vector", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
        )
    )
    return rows.join(classes, ["label", "vector"], "left").select(
        F.col("vec_id").alias(id_column), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        (F.col("vec_id") == F.coalesce("component_id", "vec_id")).alias("kept"),
    )


def op2_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{folder}/embeddings.parquet"))
