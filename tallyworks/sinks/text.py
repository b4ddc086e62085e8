"""Tab-separated text sinks."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from itertools import groupby

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tallyworks.sinks import tables
from tallyworks.sinks.tables import is_complete


def key_value_lines(frame: DataFrame, *columns: str) -> DataFrame:
    """One text column ``value``, the given columns joined by tabs."""
    return frame.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in columns]).alias("value"))


def write_key_value(frame: DataFrame, path: str, *columns: str) -> None:
    key_value_lines(frame, *columns).write.text(path)


def write_once(spark: SparkSession, make: Callable[[], DataFrame], path: str, *columns: str) -> bool:
    """The output of a job as key and value lines, unless an earlier run has finished it: whether it was made now.

    Spark leaves a commit marker when all tasks have ended. A chain of jobs that is started again after a failure finds it
    and goes on from there; output without it is replaced.
    """
    if is_complete(spark, path):
        return False
    key_value_lines(make(), *columns).write.mode("overwrite").text(path)
    return True


def write_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> None:
    """One folder ``document=<id>`` with the document's text for each document, for jobs that know documents by their place.

    Rows are brought together by id before, so a document is one file however its rows were spread. Folders stand in ``SHELVES``
    folders ``shelf=<n>`` by the hash of the id: a reader lists a shelf in one task, where Spark would start one for each of up to 10,000 folders.

    On a local or mounted file system the tasks write the files themselves: Hadoop's file system starts several processes (``chmod``)
    for each folder and file there, which took longer than all else. Any other file system is written by Spark.
    """
    rows = docs.select(F.col(doc_id).cast("string").alias("document"), F.col(text).cast("string").alias("value"))
    rows = rows.repartition("document").withColumn("shelf", F.pmod(F.xxhash64("document"), F.lit(SHELVES)))
    at, system = tables._path(docs.sparkSession, path)
    if system.getUri().getScheme() != "file":
        rows.write.partitionBy("shelf", "document").option("lineSep", "\n").text(path)
        return
    if system.exists(at):
        raise FileExistsError(f"{path} is there already")
    system.mkdirs(at)
    target = system.makeQualified(at).toUri().getPath()
    # text as bytes, which need not be decoded
    ordered = rows.sortWithinPartitions("shelf", "document").withColumn("value", F.col("value").cast("binary"))
    ordered.foreachPartition(_folder_writer(target))
    system.create(tables._path(docs.sparkSession, f"{path}/_SUCCESS")[0]).close()


# Folders that those of the documents are dealt to.
SHELVES = 256
# What Spark escapes in the name of a partition's folder, and all beyond ASCII, as a JVM may not know the names' encoding.
_ESCAPED = re.compile(rb"[\x01-\x1f\"#%'*/:=?\\\x7f-\xff{\[\]^]")
# The name that Spark gives to the folder of no value.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _folder_writer(target: str) -> Callable[[Iterator[Row]], None]:
    """A function of the rows of one task, ordered by document, that writes a folder and a file for each.

    A file gets its name when it is whole, so that a task that runs twice leaves one. The function is made here, and not
    at the top of the module, so that it is sent whole to executors that do not have this library.
    """
    escaped, no_value = _ESCAPED, _NO_VALUE

    def write(rows):
        context = TaskContext.get()
        name, attempt = f"part-{context.partitionId():05d}.txt", context.taskAttemptId()
        for (shelf, document), lines in groupby(rows, key=lambda row: (row["shelf"], row["document"] or None)):
            value = escaped.sub(lambda c: b"%%%02X" % ord(c[0]), document.encode()).decode() if document else no_value
            folder = os.path.join(target, f"shelf={shelf}", f"document={value}")
            os.makedirs(folder, exist_ok=True)
            unfinished = os.path.join(folder, f"_{name}.{attempt}")
            with open(unfinished, "wb") as file:
                file.writelines(bytes(row["value"] or b"") + b"\n" for row in lines)
            os.replace(unfinished, os.path.join(folder, name))

    return write


def pair_lines(pairs: DataFrame) -> DataFrame:
    """Pair counts as text, ``word,neighbor<TAB>n`` in one column ``value``."""
    return key_value_lines(pairs.withColumn("pair", F.concat_ws(",", "word", "neighbor")), "pair", "n")


def map_text(counts: Column) -> Column:
    """``{a=1, b=2}``, keys in ascending order."""
    entries = F.array_sort(F.map_entries(counts))
    fields = F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return F.concat(F.lit("{"), F.concat_ws(", ", fields), F.lit("}"))
