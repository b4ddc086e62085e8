"""Queries that go from files to reports through everything between, and those of the remaining sinks and readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.operators import bag_reports, cooccurrence, reports, words
from tallyworks.plans import catalogue as C
from tallyworks.plans import standins, warehouse
from tallyworks.sinks import tables
from tallyworks.sinks import text as text_sinks
from tallyworks.sources import corpus, records


# Extracts are packed, in files that are small enough for one task each, as packed text cannot be split.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 1_000_000}


def _warehouse_layout(spark: SparkSession, folder: str) -> DataFrame:
    """Extracts written as files and read back, quarantined, joined, laid out by batch.

    The warehouse build reads each extract once, into a table of its own; the files are deleted then.
    """
    paths = {name: tables.fresh_path(spark, name) for name in warehouse.SOURCES}
    attendance_path, enrollment_path, grades_path = paths.values()
    standins.attendance_text(spark, folder).write.options(**PACKED).csv(attendance_path, quote='"', escape="\\")
    standins.enrollment_text(spark, folder).write.options(**PACKED).csv(enrollment_path, quote='"', escape="\\")
    C._grades_text(spark, folder).write.options(**PACKED).text(grades_path)
    facts = warehouse.build_warehouse(
        records.read_attendance(spark, attendance_path),
        records.read_enrollment(spark, enrollment_path),
        records.read_grade_roster(spark, grades_path),
        when_read=lambda name: tables.drop(spark, paths[name]),
    )
    path = tables.fresh_path(spark, "warehouse")
    tables.overwrite_partitions(facts, path)
    return tables.read_partitioned(spark, path, facts.schema)


def chain_avg_mode(spark, folder):
    return reports.average_and_mode(_warehouse_layout(spark, folder), C.CONTAINS)


def chain_pct_below(spark, folder):
    return reports.percentage_below(_warehouse_layout(spark, folder), C.ENDS_IN)


def chain_top3(spark, folder):
    return reports.top_courses(_warehouse_layout(spark, folder), C.ENDS_IN)


def _loaded_export(spark: SparkSession, folder: str) -> DataFrame:
    return bag_reports.without_matching(C.load_export(spark, folder), C.BAG_PATTERN)


def chain_bag_avg_mode(spark, folder):
    return bag_reports.average_and_mode(_loaded_export(spark, folder))


def chain_bag_pct_below(spark, folder):
    return bag_reports.percentage_below(_loaded_export(spark, folder))


def chain_bag_top3(spark, folder):
    return bag_reports.top_courses(_loaded_export(spark, folder))


def _corpus_folders(spark: SparkSession, folder: str) -> str:
    """The documents as files, each under its id, line breaks within a text kept out of the way."""
    path = tables.fresh_path(spark, "corpus")
    one_line = F.regexp_replace(F.col("text"), "[\r\n]", " ")
    text_sinks.write_documents(standins.documents(spark, folder).select("doc_id", one_line.alias("text")), path)
    return path


def corpus_from_files(spark, folder):
    """Documents read back from files, each with the id of the folder it was read from."""
    return corpus.read_document_folders(spark, _corpus_folders(spark, folder))


def chain_top_words_pairs(spark, folder):
    """Two jobs: the top words are counted into a text file, and pairs of them are counted from the list in that file."""
    docs, path = standins.documents(spark, folder), tables.fresh_path(spark, "top-words")
    stop = corpus.read_exact_stop_words(spark, _word_file(spark, C.STOP_WORDS))

    def count():
        return words.top_words(docs, stop_words=stop, k=C.TOP_WORDS)

    text_sinks.write_once(spark, count, path, "word", "n")
    listed = corpus.read_frequent_words(spark, corpus.finished(spark, path))
    return cooccurrence.cooccurrence_pairs(standins.corpus_lines(spark, folder), listed, C.MAX_DISTANCE)


def chain_tfidf(spark, folder):
    """Three jobs over files: documents as files, terms and their frequency as a text file, scores by document file."""
    # The folders are opened once: a file for each document costs more to open than to read, and four passes follow.
    lines = tables.scratch(corpus.read_document_folders(spark, _corpus_folders(spark, folder)), "corpus-lines")
    stop = corpus.read_stop_words(spark, _word_file(spark, [f"  {w.upper()} " for w in C.STOP_WORDS]))
    path = tables.fresh_path(spark, "term-frequencies")

    def count():
        return words.top_terms(words.document_frequency(lines, "line", stop), C.TOP_TERMS)

    text_sinks.write_once(spark, count, path, "term", "df")
    listed = corpus.read_document_frequencies(spark, corpus.finished(spark, path))
    scores = words.tf_idf(lines, listed, text="line")
    return scores.withColumn("tfidf", F.round("tfidf", 6))


def chain_warehouse_from_log(spark, folder):
    """The log is stored by source, one source is logged again, and the quarantine by text reads what is stored."""
    sources = standins.attendance(spark, folder), standins.enrollment(spark, folder), standins.grade_roster(spark, folder)
    path = tables.fresh_path(spark, "stored-log")
    log = warehouse.keyed_error_records(*sources)
    # first an older run of one source, which the newer one replaces
    warehouse.store_error_log(log.where("source_table = 'enrollment_data'").limit(3), path)
    warehouse.store_error_log(log, path)
    return C._warehouse_text(warehouse.build_warehouse_from_log(*sources, path))


BUCKETS = 16


def _bucketed_roster(spark: SparkSession, folder: str) -> DataFrame:
    path = tables.fresh_path(spark, "roster-bucketed")
    name = "roster_" + path.rsplit("-", 1)[1]
    roster = standins.roster(spark, folder)
    tables.write_partitioned_bucketed(roster, name, path, buckets=BUCKETS)
    return spark.table(name).select(*roster.columns)


def roster_avg_mode_bucketed(spark, folder):
    return reports.average_and_mode(_bucketed_roster(spark, folder), C.CONTAINS)


def roster_pct_below_bucketed(spark, folder):
    return reports.percentage_below(_bucketed_roster(spark, folder), C.ENDS_IN)


def roster_top3_bucketed(spark, folder):
    return reports.top_courses(_bucketed_roster(spark, folder), C.ENDS_IN)


def _word_file(spark: SparkSession, entries: list[str]) -> str:
    path = tables.fresh_path(spark, "stop-words")
    spark.createDataFrame([(e,) for e in entries], "value string").coalesce(1).write.text(path)
    return path


def words_without_exact_stop_words(spark, folder):
    stop = corpus.read_exact_stop_words(spark, _word_file(spark, [*C.STOP_WORDS, " the ", "THE"]))
    return words.word_count(standins.documents(spark, folder), stop_words=stop)


def terms_without_trimmed_stop_words(spark, folder):
    stop = corpus.read_stop_words(spark, _word_file(spark, [f"  {w.upper()} " for w in C.STOP_WORDS]))
    return words.document_frequency(standins.documents(spark, folder), stop_words=stop)


def error_table_appended(spark, folder):
    """The error log gathered source by source in one table: created from a query, then appended to, then dropped and made again."""
    log = warehouse.error_records(
        standins.attendance(spark, folder), standins.enrollment(spark, folder), standins.grade_roster(spark, folder)
    )
    path = tables.fresh_path(spark, "error-records")
    name = "errors_" + path.rsplit("-", 1)[1]
    tables.create_table_as(log.limit(0), name, path, if_not_exists=False)
    tables.drop_table(spark, name)
    tables.create_table_as(log.limit(0), name, tables.fresh_path(spark, "error-records"))
    for source in ("course_attendance", "enrollment_data", "grade_roster_report"):
        tables.append_rows(log.where(F.col("source_table") == source), name)
    return spark.table(name)


def partitions_overwritten(spark, folder):
    """A layout in which the partitions of one year are replaced and all others stay."""
    path = tables.fresh_path(spark, "roster-by-batch")
    roster = standins.roster(spark, folder)
    tables.overwrite_partitions(roster, path)
    tables.overwrite_partitions(
        roster.where("batch = '1995'").withColumn("obtained_grade", F.lit("A")), path
    )
    found = tables.read_partitioned(spark, path, roster.schema)
    return found.groupBy("batch", "obtained_grade").agg(F.count(F.lit(1)).alias("n"))


QUERIES = [
    chain_avg_mode, chain_pct_below, chain_top3, chain_bag_avg_mode, chain_bag_pct_below, chain_bag_top3,
    corpus_from_files, words_without_exact_stop_words, terms_without_trimmed_stop_words, error_table_appended,
    partitions_overwritten, chain_top_words_pairs, chain_tfidf, chain_warehouse_from_log,
    roster_avg_mode_bucketed, roster_pct_below_bucketed, roster_top3_bucketed,
]


def queries() -> dict:
    return {query.__name__: query for query in QUERIES}
