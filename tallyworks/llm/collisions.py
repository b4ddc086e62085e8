"""Nearest neighbours by collision counting on single projections.

Every vector is projected on ``PROJECTIONS`` random lines. For each line a block of
vectors is a sorted array, in which a query opens a window centred on its own
projection. A vector collides with the query on every line whose window holds
it; when it collides on ``NEEDED`` lines it is verified by its true distance. The
windows of one query are widened together, step by step (virtual rehashing),
until the ten nearest verified so far lie within the radius that the windows
stand for.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyworks.llm.vectors import as_doubles, in_groups, matrix, usable

PROJECTIONS = 96
NEEDED = 48         # collisions before a vector is verified
REACH = 0.85        # half a window, as a part of the radius: a vector at the radius collides on 60 % of the lines
STEP = 1.12         # a radius to the next
QUERY_BLOCK = 1_024
ROWS_BLOCK = 50_000
CHUNK = 8_192       # vectors that are sorted at once in a task


def _search(k: int, projections: int, needed: int, seed: int):
    """For one block of queries and one block of vectors: the nearest found of each query."""

    def nearest(queries, vectors, ids, lines, best):
        """Widen the windows of each query over one chunk of vectors, and merge what they find into ``best``."""
        own = lines @ vectors.T
        order = np.argsort(own, axis=1, kind="stable")
        own = np.take_along_axis(own, order, axis=1)
        spread = np.median(own[:, -1] - own[:, 0]) + 1e-30
        for (query_id, query, at), top in zip(queries, best):
            count = np.zeros(len(ids), dtype=np.int16)
            seen = np.zeros(len(ids), dtype=bool)
            left = np.array([np.searchsorted(a, v) for a, v in zip(own, at)])
            right = left.copy()
            radius = top[k - 1][0] if len(top) >= k else spread / 8
            while True:
                half = REACH * radius * (1 + 1e-9)
                for line in range(projections):
                    lo = int(np.searchsorted(own[line], at[line] - half, "left"))
                    hi = int(np.searchsorted(own[line], at[line] + half, "right"))
                    count[order[line, lo:left[line]]] += 1
                    count[order[line, right[line]:hi]] += 1
                    left[line], right[line] = min(lo, left[line]), max(hi, right[line])
                fresh = np.flatnonzero((count >= needed) & ~seen)
                seen[fresh] = True
                distance = np.sqrt(((vectors[fresh] - query) ** 2).sum(axis=1))
                if len(top) >= k:
                    near = distance <= top[k - 1][0]
                    fresh, distance = fresh[near], distance[near]
                if len(fresh):
                    pairs = [p for p in zip(distance.tolist(), ids[fresh].tolist()) if p[1] != query_id]
                    top[:] = sorted(top + pairs)[:k]
                if seen.all() or (len(top) >= k and top[k - 1][0] <= radius):
                    break
                radius *= STEP

    def search(batches):
        state = None
        waiting: list[pa.RecordBatch] = []
        size = 0

        def flush():
            nonlocal waiting, size
            if waiting and state and state["queries"]:
                table = pa.Table.from_batches(waiting)
                nearest(state["queries"], matrix(table["vector"]), table["vec_id"].to_numpy(), state["lines"], state["best"])
            waiting, size = [], 0

        def results():
            rows = [(q[0], d, i) for q, top in zip(state["queries"], state["best"]) for d, i in top]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()),
                 pa.array([r[1] for r in rows], pa.float64())],
                names=["query_id", "vec_id", "score"],
            )

        lines_of: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.column_stack([
                batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "queries", "rows", "is_row")
            ])
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for start, end in zip(cuts, cuts[1:]):
                part, key = batch.slice(start, end - start), tuple(keys[start][:3].tolist())
                if state is None or state["key"] != key:
                    flush()
                    if state:
                        yield results()
                    length = int(key[0])
                    if length not in lines_of:
                        lines_of[length] = np.random.default_rng([seed, length]).normal(size=(projections, length))
                    state = {"key": key, "queries": [], "best": [], "lines": lines_of[length]}
                if keys[start][3]:
                    waiting.append(part)
                    size += part.num_rows
                    if size >= CHUNK:
                        flush()
                else:  # queries come first
                    vectors = matrix(part.column("vector"))
                    at = vectors @ state["lines"].T
                    for query_id, vector, own in zip(part.column("vec_id").to_pylist(), vectors, at):
                        state["queries"].append((query_id, vector, own))
                        state["best"].append([])
        flush()
        if state:
            yield results()

    return search


def nearest_neighbours(
    embeddings: DataFrame,
    query_condition: str,
    k: int = 10,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    projections: int = PROJECTIONS,
    needed: int = NEEDED,
    seed: int = 7,
    query_block: int = QUERY_BLOCK,
    rows_block: int = ROWS_BLOCK,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest vectors found for each query.

    Queries are the rows that meet ``query_condition`` over the id column;
    candidates are all other rows with vectors of the same length. ``score`` is the
    Euclidean distance in double precision; equal distances go to the smaller
    id. Vectors that are null, empty, zero or hold null or non-finite components
    take no part, neither as queries nor as candidates. Fewer than ``k``
    candidates are all returned; an empty table gives an empty result. Ids must
    be distinct; a row without one cannot be named in a result and takes no part. Other
    columns are not read.

    Queries go against all rows in blocks: a block of queries and a block of
    rows meet in one task, which keeps no more than a chunk of rows and the
    nearest of each query. The number of blocks follows the counts of the table.
    """
    rows = embeddings.where(usable(vector_column) & F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("vec_id"), as_doubles(vector_column).alias("vector"),
        F.expr(query_condition).alias("is_query"),
    ).withColumn("length", F.size("vector"))
    counted = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_query").alias("q")).first()
    query_blocks = max(1, -(-counted["q"] // query_block))
    row_blocks = max(1, -(-counted["n"] // rows_block))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    queries = rows.where("is_query").select(
        "length", dealt(query_blocks).alias("queries"), every(row_blocks).alias("rows"),
        F.lit(False).alias("is_row"), "vec_id", "vector",
    )
    candidates = rows.select(
        "length", every(query_blocks).alias("queries"), dealt(row_blocks).alias("rows"),
        F.lit(True).alias("is_row"), "vec_id", "vector",
    )
    keys = ["length", "queries", "rows"]
    found = in_groups(queries.unionByName(candidates), keys, ["is_row", "vec_id"]).mapInArrow(
        _search(k, projections, needed, seed), "query_id long, vec_id long, score double"
    )
    nearest = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op3_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest_neighbours(spark.read.parquet(f"{folder}/embeddings.parquet"), "vec_id % 100 = 0")
