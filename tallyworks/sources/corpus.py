"""Readers for text corpora and for the word lists the corpus jobs take."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.sinks import tables
from tallyworks.sinks.tables import is_complete


def read_corpus_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line of every file under ``path``: ``(doc_id, line)``.

    ``doc_id`` is the file name without ``.txt``. Files are split across tasks
    and lines carry no number: no corpus operator needs more than the line.
    """
    # The name comes in URL form, where a plus sign stands for itself.
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    return spark.read.text(path).select(
        F.replace(name, F.lit(".txt"), F.lit("")).alias("doc_id"),
        F.col("value").alias("line"),
    )


def read_document_folders(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, line)`` of a corpus with one folder ``document=<id>`` for each document, at any depth, as ``write_documents`` leaves it.

    The id is taken from where a line was read, not from what the file holds.

    Spark's reader keeps the place of every file in the driver. So on a local or mounted file system the tasks list and read
    the files themselves, each the folders right under ``path`` that it is dealt (the shelves of ``write_documents``). On any other
    file system Spark reads; more than ``FILES_AT_ONCE`` files are read some folders at a time into an intermediate table.
    """
    at, system = tables._path(spark, path)
    if not system.exists(at):  # a pattern of places, or an error
        return _lines_by_spark(spark, [path])
    if system.getUri().getScheme() == "file":
        return _lines_by_tasks(spark, system.makeQualified(at).toUri().getPath())
    rounds = _rounds(system, at, FILES_AT_ONCE)
    if len(rounds) < 2:
        return _lines_by_spark(spark, [path])
    target = tables.fresh_path(spark, "scratch/document-lines")
    for places in rounds:
        _lines_by_spark(spark, places).write.mode("append").parquet(target)
    return spark.read.schema("doc_id string, line string").parquet(target)


# Files whose places the driver may hold at once.
FILES_AT_ONCE = 50_000
# Tasks that the folders of a corpus are dealt to.
FOLDER_TASKS = 256


def _unescaped(name: Column, times: int) -> Column:
    for _ in range(times):  # a plus sign stands for itself
        name = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return name


def _lines_by_spark(spark: SparkSession, places: list[str]) -> DataFrame:
    folder = F.regexp_extract("_metadata.file_path", r"/document=([^/]+)/[^/]*$", 1)
    return spark.read.schema("value string").text(places, lineSep="\n", recursiveFileLookup=True).select(
        _unescaped(folder, 2).alias("doc_id"),  # once for the URL, once for the escapes in the folder's name
        F.col("value").alias("line"),
    )


def _rounds(system, at, most: int) -> list[list[str]]:
    """The folders and files right under a place, in lists of ``most`` files in all or of one folder that has more."""
    rounds, files = [], 0
    for status in system.listStatus(at):
        name = status.getPath().getName()
        if name.startswith(".") or (name.startswith("_") and "=" not in name):
            continue
        held = system.getContentSummary(status.getPath()).getFileCount()
        if not rounds or files + held > most:
            rounds.append([])
            files = 0
        rounds[-1].append(status.getPath().toString())
        files += held
    return rounds


def _lines_by_tasks(spark: SparkSession, path: str) -> DataFrame:
    entries, lines = _folder_readers()
    # From an RDD, which Spark takes to be large: no join broadcasts the corpus.
    top = spark.createDataFrame(spark.sparkContext.parallelize([(path,)], 1), "place string")
    dealt = top.mapInArrow(entries, "place binary").repartition(FOLDER_TASKS)
    return dealt.mapInArrow(lines, "folder binary, line binary").select(
        _unescaped(F.col("folder").cast("string"), 1).alias("doc_id"), F.col("line").cast("string").alias("line")
    )


def _folder_readers() -> tuple[Callable, Callable]:
    """Two functions of Arrow batches: the folders and files right under each place, and the lines of all files under each place.

    Names that Spark's reader skips are skipped, and the mark of UTF-8 at the start of a file, as there. They are made here, and not
    at the top of the module, so that they are sent whole to executors that do not have this library.
    """
    import pyarrow as pa

    def shown(name):
        hidden = name.startswith(b".") or (name.startswith(b"_") and b"=" not in name) or name.endswith(b"._COPYING_")
        return not hidden

    def entries(batches):
        for batch in batches:
            for place in batch.column(0).to_pylist():
                found = [entry.path for entry in os.scandir(os.fsencode(place)) if shown(entry.name)]
                for i in range(0, len(found), 10_000):
                    yield pa.RecordBatch.from_arrays([pa.array(found[i : i + 10_000], pa.binary())], ["place"])

    def failed(error):
        raise error

    def files(place):
        if not os.path.isdir(place):
            yield os.path.split(place)
            return
        for folder, folders, names in os.walk(place, onerror=failed, followlinks=True):
            folders[:] = filter(shown, folders)
            yield from ((folder, name) for name in names if shown(name))

    def lines_of_file(path):
        with open(path, "rb") as file:
            for i, line in enumerate(file):
                if i == 0 and line.startswith(b"\xef\xbb\xbf"):
                    line = line[3:]
                    if not line:
                        return
                yield line.removesuffix(b"\n")

    def lines(batches):
        names, held, size = [], [], 0

        def batch_of_lines():
            return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(held, pa.binary())], ["folder", "line"])

        for batch in batches:
            for place in batch.column(0).to_pylist():
                for folder, name in files(place):
                    key, _, value = os.path.basename(folder).partition(b"=")
                    document = value if key == b"document" else b""
                    for line in lines_of_file(os.path.join(folder, name)):
                        names.append(document)
                        held.append(line)
                        size += len(line)
                        if size > 1 << 22 or len(held) >= 10_000:
                            yield batch_of_lines()
                            names, held, size = [], [], 0
        if held:
            yield batch_of_lines()

    return entries, lines


def lines_of(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Cut a text column at line feeds: ``(doc_id, line_no, line)``, lines counted from 0."""
    return documents.select(
        F.col(doc_id).alias("doc_id"), F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line")
    )


def read_exact_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """One entry per line, taken as it stands."""
    return spark.read.text(path).select(F.col("value").alias("word"))


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """One entry per line, trimmed and lowercased."""
    return spark.read.text(path).select(F.lower(F.trim("value")).alias("word"))


def finished(spark: SparkSession, path: str) -> str:
    """``path``, if the job that writes it has left its commit marker there; half of a list is never read."""
    if not is_complete(spark, path):
        raise FileNotFoundError(f"no complete output of an earlier job in {path}")
    return path


def read_frequent_words(spark: SparkSession, path: str) -> DataFrame:
    """First tab-separated field of each line, lowercased; blank entries dropped."""
    word = F.lower(F.split_part(F.col("value"), F.lit("\t"), F.lit(1)))
    return spark.read.text(path).select(word.alias("word")).where(F.trim("word") != "")


def read_document_frequencies(spark: SparkSession, path: str) -> DataFrame:
    """``term<TAB>df`` lines, trimmed: ``(term, df)``."""
    fields = F.split(F.trim("value"), "\t")
    return (
        spark.read.text(path)
        .select(F.get(fields, 0).alias("term"), F.get(fields, 1).try_cast("int").alias("df"))
        .where(F.col("term") != "")
    )
