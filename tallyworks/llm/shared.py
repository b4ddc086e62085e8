"""What the operators of this package share: tables in the shared folder, text as bytes, components."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The bytes that separate words, [\x20\x09-\x0D].
SPACES = b" \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors reach, named by ``spark.checkpoint.dir``.

    Only a local session may lack the setting (as in tests); it is then set once.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="tallyworks-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def written(frame: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    table = spark.read.schema(frame.schema).parquet(path)
    table.written_at = path
    return table


# Of what Spark sends to a Python worker at once; by default 10,000 rows, which may be hundreds of megabytes of text.
ROWS_SENT, BYTES_SENT = 1_000, 8 << 20


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Tables ``written`` inside go to Python in small batches, which both the worker and the executor hold whole."""
    limits = {
        "spark.sql.execution.arrow.maxRecordsPerBatch": ROWS_SENT, "spark.sql.execution.arrow.maxBytesPerBatch": BYTES_SENT,
    }
    before = {name: spark.conf.get(name, None) for name in limits}
    for name, limit in limits.items():
        spark.conf.set(name, str(limit))
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def discard(table: DataFrame) -> None:
    """Delete a table of ``written`` once what was made of it is written too; other frames are left alone."""
    path = vars(table).get("written_at")
    if path:
        _delete(table.sparkSession, path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_written(spark: SparkSession) -> None:
    """Delete every table that ``written`` left in the shared folder; call it when no result is read any more."""
    _delete(spark, f"{shared_folder(spark)}/llm")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, unless they find it on the same path as the driver."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    context = spark.sparkContext
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or context.applicationId in _shipped:
        return
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="tallyworks-"), "tallyworks"), "zip", root, "tallyworks"
    )
    context.addPyFile(archive)  # the driver's own copy; Spark hands it to the executors
    _shipped.add(context.applicationId)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def by_place(docs: DataFrame) -> DataFrame:
    """``(place, doc_id, text)``: distinct numbers in the order of the ids.

    Places are the ids themselves where these are distinct and not null. Otherwise
    the rows are sorted by id, nulls last, and text, and numbered in a written table.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    odd = own.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1 OR doc_id IS NULL")
    if odd.isEmpty():
        return own.select(F.col("doc_id").alias("place"), "doc_id", "text")
    # equal rows are many places in a row, so they are told apart for the ranges of the sort
    ordered = own.withColumn("tie", F.monotonically_increasing_id()).orderBy(
        F.asc_nulls_last("doc_id"), "text", "tie"
    )
    return written(ordered.select(F.monotonically_increasing_id().alias("place"), "doc_id", "text"), "places")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, component)`` for the nodes of ``edges(a, b)``: the smallest node reachable.

    Alternating large-star and small-star rounds: the number of rounds grows with
    the logarithm of the longest path, not with the path. Every round is a
    written table. A node linked to very many others costs one aggregate over
    its links, which is combined before the shuffle, and a join that adaptive
    execution splits.
    """
    def smaller_first(frame: DataFrame) -> DataFrame:
        return (
            frame.where("a != b")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .distinct()
        )

    def large_star(links: DataFrame) -> DataFrame:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
        return both.join(smallest, "a").where("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b"))

    def small_star(links: DataFrame) -> DataFrame:
        smallest = links.groupBy("a").agg(F.min("b").alias("_m"))
        joined = links.join(smallest, "a")
        return joined.select(F.col("b").alias("a"), F.col("_m").alias("b")).unionByName(
            smallest.select("a", F.col("_m").alias("b"))
        )

    links = written(smaller_first(edges.select("a", "b")), name)
    while True:
        after = written(smaller_first(small_star(smaller_first(large_star(links)))), name)
        sums = [
            frame.agg(
                F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
            ).first()
            for frame in (links, after)
        ]
        discard(links)
        links = after
        if tuple(sums[0]) == tuple(sums[1]):
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


# Arithmetic on unsigned 64-bit numbers, wrapping round.

_ODD = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit value for each 64-bit value."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def table_of(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _ODD + np.uint64(seed))


def powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def sliding_sums(x: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A 64-bit hash of each window of ``n`` consecutive 64-bit values."""
    if len(x) < n:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(x) - n + 1, dtype=np.uint64)
    base = (2 * seed + 1) * int(_ODD) % 2**64 | 1
    # by doubling: h[2k](i) = h[k](i) * base^k + h[k](i + k)
    total, done, part, size, factor = out, 0, x, 1, np.uint64(base)
    rest = n
    while rest:
        if rest & 1:
            total = part[done:done + len(out)].copy() if not done else total * factor + part[done:done + len(out)]
            done += size
        rest >>= 1
        if rest:
            part = part[:-size] * factor + part[size:]
            base = base * base % 2**64
            size, factor = size * 2, np.uint64(base)
    return mix(total)


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of UTF-8 text, as byte positions."""
    is_space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], is_space, [True])).astype(np.int8)))
    return edge[::2], edge[1::2]


_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(SPACES)] = True
_BYTE = table_of(11, 256)
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word. Equal words get equal hashes wherever they stand."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(_BYTE[data] * powers(len(data), _BASE))))
    back = powers(int(starts[-1]) + 1, _INVERSE)[starts]
    return mix((sums[ends] - sums[starts]) * back + (ends - starts).astype(np.uint64) * _ODD)
