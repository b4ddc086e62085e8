"""Every operator as a named query over a data folder: ``(spark, folder) -> DataFrame``.

Arrays, maps, dates and decimals leave a query as text, so that results can be
compared with those of another engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.functions import records as R
from tallyworks.functions import stemming
from tallyworks.functions import text as T
from tallyworks.operators import bag_reports, cooccurrence, quality, quarantine, reports, words
from tallyworks.plans import standins, warehouse
from tallyworks.sinks import tables
from tallyworks.sinks import text as text_sinks
from tallyworks.sources import corpus, records, schemas

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the queries on the given tables.
CONTAINS = "%1%"
ENDS_IN = "%1"
BAG_PATTERN = ".*1.*"
STOP_WORDS = ["the", "of", "and", "to", "in", "a", "is", "de", "la", "le", "der", "die", "que", "en"]
TOP_WORDS = 50
TOP_TERMS = 100
MAX_DISTANCE = 4

_catalogue: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _catalogue[function.__name__] = function
    return function


def catalogue() -> dict[str, Query]:
    return dict(_catalogue)


def _stop_words(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{w}')" for w in STOP_WORDS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS stop(word)")


def _vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    return words.top_words(standins.documents(spark, folder), k=TOP_WORDS).select("word")


def _cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return bag_reports.without_matching(standins.export(spark, folder), BAG_PATTERN)


def _warehouse_text(frame: DataFrame) -> DataFrame:
    return frame.select(*[
        R.joined_list(name).alias(name) if kind.startswith("array")
        else F.col(name).cast("string").alias(name) if kind in ("date", "decimal(5,2)")
        else F.col(name)
        for name, kind in frame.dtypes
    ])


# --- reading and writing -------------------------------------------------------------------


@_query
def load_attendance(spark, folder):
    path = tables.fresh_path(spark, "attendance-csv")
    standins.attendance_text(spark, folder).write.csv(path, quote='"', escape="\\")
    return _warehouse_text(records.read_attendance(spark, path))


@_query
def load_enrollment(spark, folder):
    path = tables.fresh_path(spark, "enrollment-csv")
    standins.enrollment_text(spark, folder).write.csv(path, quote='"', escape="\\")
    return _warehouse_text(records.read_enrollment(spark, path))


@_query
def load_grade_roster(spark, folder):
    path = tables.fresh_path(spark, "grades-csv")
    _grades_text(spark, folder).write.text(path)
    return records.read_grade_roster(spark, path)


def _grades_text(spark: SparkSession, folder: str) -> DataFrame:
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in schemas.GRADE_ROSTER_COLUMNS]
    return standins.grade_roster(spark, folder).select(F.concat_ws(",", *fields))


@_query
def load_export(spark, folder):
    """Write a warehouse as delimited text, the faculty list joined, and read it back by position."""
    path = tables.fresh_path(spark, "export-csv")
    facts = _warehouse_text(warehouse.join_sources(*map(warehouse.numbered, (
        standins.enrollment(spark, folder), standins.attendance(spark, folder), standins.grade_roster(spark, folder)
    ))))
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in facts.columns]
    facts.select(F.concat_ws(",", *fields)).write.text(path)
    return records.read_warehouse_export(spark, path).withColumn(
        "attendance", F.round(F.col("attendance").cast("double"), 2)
    )


@_query
def corpus_lines(spark, folder):
    return standins.corpus_lines(spark, folder)


@_query
def frequent_word_list(spark, folder):
    """The word list as the counting job leaves it for the co-occurrence jobs."""
    path = tables.fresh_path(spark, "frequent-words")
    top = words.top_words(standins.documents(spark, folder), k=TOP_WORDS)
    text_sinks.write_key_value(top, path, "word", "n")
    return corpus.read_frequent_words(spark, path)


@_query
def document_frequency_list(spark, folder):
    """The term table as the document-frequency job leaves it for the TF-IDF job."""
    path = tables.fresh_path(spark, "terms")
    frequencies = words.document_frequency(standins.documents(spark, folder), stop_words=_stop_words(spark))
    text_sinks.write_key_value(words.top_terms(frequencies, TOP_TERMS), path, "term", "df")
    return corpus.read_document_frequencies(spark, path)


@_query
def orc_roundtrip(spark, folder):
    path = tables.fresh_path(spark, "roster-orc")
    frame = standins.roster(spark, folder)
    tables.write_orc(frame, path)
    return _warehouse_text(spark.read.schema(frame.schema).orc(path))


def _partitioned_layout(spark: SparkSession, folder: str) -> tuple[str, str]:
    """Table name and path of a partitioned layout of the roster, written anew."""
    path = tables.fresh_path(spark, "roster-partitioned")
    name = "roster_" + path.rsplit("-", 1)[1]
    tables.write_partitioned_bucketed(standins.roster(spark, folder), name, path)
    return name, path


def _partitioned_roster(spark: SparkSession, folder: str) -> DataFrame:
    _, path = _partitioned_layout(spark, folder)
    return tables.read_partitioned(spark, path, standins.roster(spark, folder).schema)


@_query
def warehouse_partitioned(spark, folder):
    name, _ = _partitioned_layout(spark, folder)
    columns = standins.roster(spark, folder).columns
    return _warehouse_text(spark.table(name).select(*columns))


@_query
def stripes_text(spark, folder):
    pairs = cooccurrence.cooccurrence_pairs(standins.corpus_lines(spark, folder), _vocabulary(spark, folder))
    striped = cooccurrence.stripes(pairs).withColumn("stripe", text_sinks.map_text(F.col("stripe")))
    return text_sinks.key_value_lines(striped, "word", "stripe")


@_query
def pairs_text(spark, folder):
    return text_sinks.pair_lines(
        cooccurrence.cooccurrence_pairs(standins.corpus_lines(spark, folder), _vocabulary(spark, folder))
    )


# --- projections and scalar expressions ------------------------------------------------------


@_query
def project_rename(spark, folder):
    return standins.roster(spark, folder).select(
        F.col("course").alias("subject"), "student_id", F.col("obtained_grade").alias("grade")
    )


@_query
def split_to_array(spark, folder):
    items = R.split_list("instructors")
    return standins.attendance_text(spark, folder).select(
        "name_hash", F.array_join(items, "|").alias("items"), F.size(items).cast("long").alias("n_items")
    )


@_query
def percent_to_decimal(spark, folder):
    return standins.attendance_text(spark, folder).select(
        "member_id_hash", "avg_attendance_percent",
        R.percent_to_decimal("avg_attendance_percent").cast("string").alias("percent"),
    )


@_query
def row_to_text(spark, folder):
    return standins.attendance(spark, folder).select(quality.attendance_checks().row.alias("original_row"))


@_query
def parse_short_date(spark, folder):
    return standins.enrollment_text(spark, folder).select(
        "student_id", "enrollment_date", R.short_date("enrollment_date").cast("string").alias("parsed")
    )


@_query
def tokenize_words(spark, folder):
    listed = F.filter(T.words("line"), lambda w: w != "")
    return standins.corpus_lines(spark, folder).select(
        "doc_id", "line_no", F.array_join(listed, "|").alias("words"), F.size(listed).cast("long").alias("n_words")
    )


@_query
def tokenize_positions(spark, folder):
    return standins.corpus_lines(spark, folder).select(
        "doc_id", "line_no", F.posexplode(T.raw_tokens("line")).alias("position", "token")
    )


@_query
def clean_letters(spark, folder):
    tokens = standins.documents(spark, folder).select(F.explode(T.raw_tokens("text")).alias("token"))
    return tokens.groupBy(T.letters_only("token").alias("letters")).agg(F.count(F.lit(1)).alias("n"))


@_query
def letter_slots(spark, folder):
    return standins.corpus_lines(spark, folder).select(
        "doc_id", "line_no", F.array_join(T.letter_slots("line"), "|").alias("slots")
    )


@_query
def stem_vocabulary(spark, folder):
    tokens = standins.documents(spark, folder).select(F.explode(T.letter_digit_tokens("text")).alias("token"))
    return stemming.stem_vocabulary(tokens)


def _top_terms(spark: SparkSession, folder: str) -> DataFrame:
    frequencies = words.document_frequency(standins.documents(spark, folder), stop_words=_stop_words(spark))
    return words.top_terms(frequencies, TOP_TERMS)


@_query
def idf(spark, folder):
    n_docs = standins.documents(spark, folder).agg(F.count(F.lit(1))).scalar()
    return _top_terms(spark, folder).select(
        "term", "df",
        F.round(T.inverse_document_frequency(n_docs, F.col("df")), 9).alias("idf"),
        F.round(T.inverse_document_frequency(n_docs, F.col("df"), "real"), 9).alias("real_idf"),
    )


# --- data quality ----------------------------------------------------------------------------


def _rule_hits(frame: DataFrame, checks: quality.Checked, column: str, issue: str) -> DataFrame:
    broken = [r.broken for r in checks.rules if (r.column_name, r.issue_type) == (column, issue)][0]
    return frame.where(broken).select(checks.row.alias("original_row"))


@_query
def dq_missing_text(spark, folder):
    return _rule_hits(
        standins.attendance(spark, folder), quality.attendance_checks(), "member_id_hash", quality.MISSING
    )


@_query
def dq_array_missing(spark, folder):
    return _rule_hits(standins.attendance(spark, folder), quality.attendance_checks(), "instructors", quality.MISSING)


@_query
def dq_regex_format(spark, folder):
    return _rule_hits(standins.attendance(spark, folder), quality.attendance_checks(), "email_hash", quality.INVALID)


@_query
def dq_out_of_range(spark, folder):
    return _rule_hits(
        standins.attendance(spark, folder), quality.attendance_checks(), "avg_attendance_percent", quality.OUT_OF_RANGE
    )


@_query
def dq_not_in_list(spark, folder):
    return _rule_hits(
        standins.grade_roster(spark, folder), quality.grade_roster_checks(), "obtained_marks_grade", quality.INVALID
    )


@_query
def dq_date_format(spark, folder):
    return _rule_hits(
        standins.enrollment(spark, folder), quality.enrollment_checks(), "enrollment_date", quality.INVALID
    )


@_query
def dq_union_rules(spark, folder):
    frame = standins.attendance(spark, folder)
    return quality.error_log_by_union(frame, quality.attendance_checks()).drop("entity_key")


@_query
def dq_error_records(spark, folder):
    return warehouse.error_records(
        standins.attendance(spark, folder), standins.enrollment(spark, folder), standins.grade_roster(spark, folder)
    )


# --- quarantine and warehouse ----------------------------------------------------------------


def _attendance_and_errors(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    frame = standins.attendance(spark, folder)
    return frame, quality.error_log(frame, quality.attendance_checks())


@_query
def anti_join_key(spark, folder):
    frame, errors = _attendance_and_errors(spark, folder)
    return _warehouse_text(quarantine.quarantine_by_key(frame, "member_id_hash", errors))


@_query
def anti_join_like(spark, folder):
    frame, errors = _attendance_and_errors(spark, folder)
    return _warehouse_text(quarantine.quarantine_by_text(frame, "member_id_hash", errors))


@_query
def distinct_rows(spark, folder):
    return standins.grade_roster(spark, folder).distinct()


@_query
def warehouse_join(spark, folder):
    return _warehouse_text(warehouse.join_sources(
        warehouse.numbered(standins.enrollment(spark, folder)), warehouse.numbered(standins.attendance(spark, folder)),
        standins.grade_roster(spark, folder).distinct(),
    ))


@_query
def warehouse_build(spark, folder):
    return _warehouse_text(warehouse.build_warehouse(
        standins.attendance(spark, folder), standins.enrollment(spark, folder), standins.grade_roster(spark, folder)
    ))


@_query
def warehouse_build_like(spark, folder):
    return _warehouse_text(warehouse.build_warehouse_by_text(
        standins.attendance(spark, folder), standins.enrollment(spark, folder), standins.grade_roster(spark, folder)
    ))


# --- reports by course and batch --------------------------------------------------------------


@_query
def roster_avg(spark, folder):
    return reports.average_attendance(standins.roster(spark, folder))


@_query
def roster_grade_counts(spark, folder):
    return reports.grade_counts(standins.roster(spark, folder))


@_query
def roster_mode(spark, folder):
    return reports.mode_grade(standins.roster(spark, folder))


@_query
def roster_avg_mode(spark, folder):
    return reports.average_and_mode(standins.roster(spark, folder), CONTAINS)


@_query
def roster_avg_mode_joined(spark, folder):
    return reports.average_and_mode_by_join(standins.roster(spark, folder), CONTAINS)


@_query
def roster_pct_below(spark, folder):
    return reports.percentage_below(standins.roster(spark, folder), ENDS_IN)


@_query
def roster_top3(spark, folder):
    return reports.top_courses(standins.roster(spark, folder), ENDS_IN)


@_query
def roster_avg_mode_partitioned(spark, folder):
    return reports.average_and_mode(_partitioned_roster(spark, folder), CONTAINS)


@_query
def roster_pct_below_partitioned(spark, folder):
    return reports.percentage_below(_partitioned_roster(spark, folder), ENDS_IN)


@_query
def roster_top3_partitioned(spark, folder):
    return reports.top_courses(_partitioned_roster(spark, folder), ENDS_IN)


# --- reports by course and program, bag semantics ---------------------------------------------


@_query
def pig_filter_matches(spark, folder):
    return _cleaned(spark, folder).withColumn("attendance", F.col("attendance").cast("double"))


@_query
def pig_avg(spark, folder):
    return bag_reports.average_attendance(_cleaned(spark, folder))


@_query
def pig_grade_counts(spark, folder):
    return bag_reports.grade_counts(_cleaned(spark, folder))


@_query
def pig_mode(spark, folder):
    return bag_reports.mode_grade(_cleaned(spark, folder))


@_query
def pig_avg_mode(spark, folder):
    return bag_reports.average_and_mode(_cleaned(spark, folder))


@_query
def pig_pct_below(spark, folder):
    return bag_reports.percentage_below(_cleaned(spark, folder))


@_query
def pig_top3(spark, folder):
    return bag_reports.top_courses(_cleaned(spark, folder))


@_query
def pig_flatten_cross(spark, folder):
    return bag_reports.top_courses_crossed(_cleaned(spark, folder))


@_query
def group_bag(spark, folder):
    bags = bag_reports.mode_bags(bag_reports.grade_counts(_cleaned(spark, folder)))
    return bags.select(*[
        F.concat(F.lit("["), F.array_join(c, ",", "null"), F.lit("]")).alias(c) for c in bags.columns
    ])


@_query
def flatten_bag(spark, folder):
    bags = bag_reports.mode_bags(bag_reports.grade_counts(_cleaned(spark, folder)))
    return bag_reports.flatten(bags, *bags.columns)


@_query
def pig_all_reports(spark, folder):
    """The three reports from one summary, as ``(report, course, program_name, measure, grade)``."""
    found = bag_reports.all_reports(bag_reports.summary(_cleaned(spark, folder)))
    none = F.lit(None).cast("string")
    return (
        found.average_and_mode.select(
            F.lit(1).alias("report"), "course", "program_name",
            F.col("avg_attendance").alias("measure"), F.col("mode_grade").alias("grade"),
        )
        .union(found.percentage_below.select(F.lit(2), "course", "program_name", "percentage_below_50_attendance", none))
        .union(found.top_courses.select(F.lit(3), "course", "program_name", "average_attendance", none))
    )


# --- word counts --------------------------------------------------------------------------------


@_query
def word_count(spark, folder):
    return words.word_count(standins.documents(spark, folder))


@_query
def word_count_case_sensitive(spark, folder):
    return words.word_count(standins.documents(spark, folder), case_sensitive=True)


@_query
def stopword_anti_join(spark, folder):
    return words.word_count(standins.documents(spark, folder), stop_words=_stop_words(spark))


@_query
def top_words(spark, folder):
    return words.top_words(standins.documents(spark, folder), stop_words=_stop_words(spark), k=TOP_WORDS)


@_query
def vocab_semi_join(spark, folder):
    tokens = standins.documents(spark, folder).select(F.explode(T.letter_slots("text")).alias("word"))
    kept = words.keep_listed(tokens, "word", _vocabulary(spark, folder))
    return kept.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


# --- co-occurrence ------------------------------------------------------------------------------


def _pairs(distance: int, local_agg: str = "task") -> Query:
    def query(spark, folder):
        return cooccurrence.cooccurrence_pairs(
            standins.corpus_lines(spark, folder), _vocabulary(spark, folder), distance, local_agg=local_agg
        )

    return query


def _striped(distance: int, local_agg: str = "task") -> Query:
    def query(spark, folder):
        striped = cooccurrence.stripes(_pairs(distance, local_agg)(spark, folder))
        return striped.withColumn("stripe", text_sinks.map_text(F.col("stripe")))

    return query


_catalogue["cooc_pairs"] = _pairs(1)
_catalogue["cooc_stripes"] = _striped(1)
for _d in range(1, MAX_DISTANCE + 1):
    _catalogue[f"cooc_pairs_d{_d}"] = _pairs(_d)
    _catalogue[f"cooc_stripes_d{_d}"] = _striped(_d)
_catalogue["cooc_pairs_line_agg"] = _pairs(MAX_DISTANCE, "line")
_catalogue["cooc_stripes_line_agg"] = _striped(MAX_DISTANCE, "line")


@_query
def cooc_stripes_flattened(spark, folder):
    return cooccurrence.unstriped(cooccurrence.stripes(_pairs(1)(spark, folder)))


@_query
def cooc_distance_sweep(spark, folder):
    return cooccurrence.distance_sweep(
        standins.corpus_lines(spark, folder), _vocabulary(spark, folder), MAX_DISTANCE
    )


@_query
def cooc_distance_sweep_line_agg(spark, folder):
    return cooccurrence.distance_sweep(
        standins.corpus_lines(spark, folder), _vocabulary(spark, folder), MAX_DISTANCE, local_agg="line"
    )


# --- document frequency and TF-IDF ------------------------------------------------------------------


@_query
def document_frequency(spark, folder):
    return words.document_frequency(standins.documents(spark, folder), stop_words=_stop_words(spark))


@_query
def line_frequency(spark, folder):
    return words.document_frequency(standins.corpus_lines(spark, folder), "line", _stop_words(spark))


@_query
def document_frequency_from_lines(spark, folder):
    """Documents given as loose lines: terms are made distinct per document by a shuffle."""
    return words.document_frequency(standins.corpus_lines(spark, folder), "line", _stop_words(spark), key="doc_id")


@_query
def top_terms_by_df(spark, folder):
    return _top_terms(spark, folder)


@_query
def term_frequency(spark, folder):
    return words.term_frequency(standins.documents(spark, folder), _top_terms(spark, folder).select("term"))


@_query
def tfidf(spark, folder):
    scores = words.tf_idf(standins.documents(spark, folder), _top_terms(spark, folder))
    return scores.withColumn("tfidf", F.round("tfidf", 6))


@_query
def tfidf_normalized(spark, folder):
    """Tokens cleaned as for the document frequency, exact quotient in the logarithm."""
    scores = words.tf_idf(
        standins.documents(spark, folder), _top_terms(spark, folder), idf="real", normalize=True
    )
    return scores.withColumn("tfidf", F.round("tfidf", 6))
