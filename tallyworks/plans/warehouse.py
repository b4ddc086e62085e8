"""The records warehouse: error log, quarantine, fact table, partitioned layout."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.functions import records as R
from tallyworks.operators import quality, quarantine
from tallyworks.operators.joins import HOT_ROWS, hot_keys, maybe_hot, salted_inner_join
from tallyworks.sinks import tables

KEYS = ["student_id", "course"]
ROW = "_row"
SOURCES = ["course_attendance", "enrollment_data", "grade_roster_report"]


def error_records(attendance: DataFrame, enrollment: DataFrame, grades: DataFrame) -> DataFrame:
    """The error log of all three sources, one pass over each."""
    return keyed_error_records(attendance, enrollment, grades).drop("entity_key")


def keyed_error_records(attendance: DataFrame, enrollment: DataFrame, grades: DataFrame) -> DataFrame:
    """The same with the key of each logged row, ``entity_key``."""
    log = quality.error_log(attendance, quality.attendance_checks())
    log = log.unionByName(quality.error_log(enrollment, quality.enrollment_checks()))
    return log.unionByName(quality.error_log(grades, quality.grade_roster_checks()))


def numbered(source: DataFrame) -> DataFrame:
    """Number the rows of a file or table, so that even exact copies of a hot row can be spread.

    Only for a source as it is scanned: the numbers must come out the same when
    a task runs again.
    """
    return source.withColumn(ROW, F.monotonically_increasing_id())


def _spread(source: DataFrame) -> Column:
    """What tells the rows of a hot key apart: their number if they have one, else their content."""
    return (F.col(ROW) if ROW in source.columns else F.xxhash64(*source.columns)).alias(ROW)


def _enrollment_columns(enrollment: DataFrame, *keep: str) -> DataFrame:
    return enrollment.select(
        "student_id", "course", "student_name", "program", "batch",
        F.col("primary_faculty").alias("faculty"), "course_type", "period",
        R.short_date("enrollment_date").alias("enrollment_date"),
        _spread(enrollment), *keep,
    )


def _attendance_columns(attendance: DataFrame, *keep: str) -> DataFrame:
    return attendance.select(
        F.col("member_id_hash").alias("student_id"), "course",
        "classes_attended", "classes_absent", "avg_attendance_percent",
        _spread(attendance), *keep,
    )


def _grade_columns(grades: DataFrame, *keep: str) -> DataFrame:
    return grades.select(
        "student_id", F.col("subject_code_name").alias("course"),
        F.col("obtained_marks_grade").alias("obtained_grade"),
        F.col("out_of_marks_grade").alias("total_marks"), "exam_result",
        _spread(grades), *keep,
    )


def hot_student_courses(
    enrollment: DataFrame, attendance: DataFrame, grades: DataFrame, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """The student and course keys that hold most rows of a source."""
    frames = [_enrollment_columns(enrollment), _attendance_columns(attendance), _grade_columns(grades)]
    return hot_keys(frames, KEYS, hot_rows)


def join_sources(
    enrollment: DataFrame, attendance: DataFrame, grades: DataFrame, hot: DataFrame | None = None
) -> DataFrame:
    """The fact table: inner join of the three sources on student and course, hot keys spread."""
    if hot is None:
        hot = hot_student_courses(enrollment, attendance, grades)
    return _joined([_enrollment_columns(enrollment), _attendance_columns(attendance), _grade_columns(grades)], hot)


def _joined(frames: list[DataFrame], hot: DataFrame) -> DataFrame:
    named = [frame.withColumnRenamed(ROW, f"{ROW}_{i}") for i, frame in enumerate(frames)]
    joined = salted_inner_join(named, KEYS, [f"{ROW}_{i}" for i in range(len(named))], hot)
    return joined.select(
        "student_id", "student_name", "program", "batch", "course", "faculty", "course_type", "period",
        "enrollment_date", "classes_attended", "classes_absent", "avg_attendance_percent",
        "obtained_grade", "total_marks", "exam_result",
    )


def _narrow(frame: DataFrame, columns: DataFrame, checks: quality.Checked) -> DataFrame:
    """The columns of a source that the warehouse needs, its rows numbered and each marked if it breaks a rule, written once."""
    broken = F.greatest(*[F.coalesce(rule.broken, F.lit(False)) for rule in checks.rules], F.lit(False))
    return tables.scratch(columns(frame.withColumn("_broken", broken), "_broken"), "narrow")


def build_warehouse(
    attendance: DataFrame, enrollment: DataFrame, grades: DataFrame, hot_rows: int = HOT_ROWS,
    when_read: Callable[[str], None] | None = None,
) -> DataFrame:
    """Quarantine by key, then join the clean rows of the three sources, which must be files or tables.

    A row survives only if its student is clean in all three sources, because
    the join asks for the same student in each. One anti-join of the enrollment
    rows with the broken keys of all sources therefore does the work of three.
    Rows without a key could stay in a source but never reach the join.

    Each source is read once: the pass applies the rules and writes the few columns that are needed, each row with its number and
    whether it is broken. The broken keys and the hot keys are found in those tables. ``when_read`` is called with the name of each
    source that will not be read any more.
    """
    sources = []
    for name, source, columns, checks in (
        ("enrollment_data", numbered(enrollment), _enrollment_columns, quality.enrollment_checks()),
        ("course_attendance", numbered(attendance), _attendance_columns, quality.attendance_checks()),
        ("grade_roster_report", grades.distinct(), _grade_columns, quality.grade_roster_checks()),
    ):
        sources.append(_narrow(source, columns, checks))
        if when_read:
            when_read(name)
    bad = reduce(
        DataFrame.unionByName, [s.where("_broken").select(F.col("student_id").alias("entity_key")) for s in sources]
    )
    bad = tables.scratch(quarantine.with_empty_key(bad), "broken-keys")
    hot = tables.scratch(hot_keys(maybe_hot(sources, KEYS, hot_rows), KEYS, hot_rows), "hot-keys")
    enrolled, attended, graded = [s.drop("_broken") for s in sources]
    clean = enrolled.join(bad, enrolled["student_id"] == bad["entity_key"], "left_anti")
    return _joined([clean, attended, graded], hot)


def store_error_log(log: DataFrame, path: str) -> None:
    """Keep the log entries of the sources in ``log`` as the newest run of each source under ``path``.

    A run is a folder of its own and counts once its commit marker is there, so a source that is logged
    again is replaced in one step and a run that failed halfway is never read.
    """
    spark = log.sparkSession
    for source in SOURCES:
        run = len(tables.folders(spark, f"{path}/source_table={source}"))
        log.where(F.col("source_table") == source).drop("source_table").write.orc(f"{path}/source_table={source}/run={run}")


def stored_error_log(spark: SparkSession, path: str, source: str | None = None) -> DataFrame:
    """The newest complete run of each source, or of one: ``(original_row, column_name, issue_type, entity_key, source_table)``."""
    runs = []
    for name in [source] if source else SOURCES:
        done = [f for f in tables.folders(spark, f"{path}/source_table={name}") if tables.is_complete(spark, f)]
        runs += sorted(done, key=lambda folder: int(folder.rsplit("=", 1)[1]))[-1:]
    if not runs:
        raise ValueError(f"no complete run of {source or 'any source'} under {path}")
    schema = "original_row string, column_name string, issue_type string, entity_key string, source_table string, run int"
    stored = spark.read.schema(schema).option("basePath", path).orc(runs).drop("run")
    return stored.where(F.col("source_table") == source) if source else stored


def build_warehouse_from_log(
    attendance: DataFrame, enrollment: DataFrame, grades: DataFrame, path: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """The warehouse with the quarantine by text, against the log stored under ``path`` instead of one computed anew."""
    spark = attendance.sparkSession
    of = {source: stored_error_log(spark, path, source) for source in SOURCES}
    return join_sources(
        quarantine.quarantine_by_text(numbered(enrollment), "student_id", of["enrollment_data"]),
        quarantine.quarantine_by_text(numbered(attendance), "member_id_hash", of["course_attendance"]),
        quarantine.quarantine_by_text(grades.distinct(), "student_id", of["grade_roster_report"]),
        hot_student_courses(enrollment, attendance, grades, hot_rows),
    )


def build_warehouse_by_text(
    attendance: DataFrame, enrollment: DataFrame, grades: DataFrame, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """The same with the quarantine that looks for keys anywhere in the logged rows."""
    return join_sources(
        quarantine.quarantine_by_text(
            numbered(enrollment), "student_id", quality.error_log(enrollment, quality.enrollment_checks())
        ),
        quarantine.quarantine_by_text(
            numbered(attendance), "member_id_hash", quality.error_log(attendance, quality.attendance_checks())
        ),
        quarantine.quarantine_by_text(
            grades.distinct(), "student_id", quality.error_log(grades, quality.grade_roster_checks())
        ),
        hot_student_courses(enrollment, attendance, grades, hot_rows),
    )
