"""Rule-based data-quality checks and the error log they write."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions import records as R
from tallyworks.sources import schemas

MISSING = "Missing Value"
INVALID = "Invalid Format"
OUT_OF_RANGE = "Out of Range"

# Accepted formats and values.
HASH_PATTERN = "^[a-fA-F0-9]{64}$"
EXAM_RESULTS = ["PASS", "FAIL"]
GRADES = ["A", "A-", "B+", "B", "B-", "C+", "C", "D", "F", "S"]
ATTENDANCE_RANGE = (0, 100)


class Rule(NamedTuple):
    """A row breaks the rule where ``broken`` is true (NULL counts as not broken)."""

    column_name: str
    issue_type: str
    broken: Column


class Checked(NamedTuple):
    """How one source table is checked and logged."""

    source_table: str
    key: str
    row: Column
    rules: list[Rule]


def attendance_checks() -> Checked:
    return Checked(
        "course_attendance",
        "member_id_hash",
        R.row_text(
            "course", R.joined_list("instructors"), "name_hash", "email_hash", "member_id_hash",
            "classes_attended", "classes_absent", "avg_attendance_percent",
        ),
        [
            Rule("course", MISSING, R.is_missing_text("course")),
            Rule("instructors", MISSING, R.is_missing_list("instructors")),
            Rule("email_hash", MISSING, R.is_missing_text("email_hash")),
            Rule("email_hash", INVALID, R.breaks_pattern("email_hash", HASH_PATTERN)),
            Rule("member_id_hash", MISSING, R.is_missing_text("member_id_hash")),
            Rule(
                "avg_attendance_percent", OUT_OF_RANGE,
                R.outside_range("avg_attendance_percent", *ATTENDANCE_RANGE),
            ),
        ],
    )


def enrollment_checks() -> Checked:
    return Checked(
        "enrollment_data",
        "student_id",
        R.row_text(*schemas.ENROLLMENT_COLUMNS[:-1], R.joined_list("primary_faculty")),
        [
            Rule("enrollment_date", MISSING, R.is_missing_text("enrollment_date")),
            Rule("enrollment_date", INVALID, R.not_short_date("enrollment_date")),
        ],
    )


def grade_roster_checks() -> Checked:
    return Checked(
        "grade_roster_report",
        "student_id",
        R.row_text(*schemas.GRADE_ROSTER_COLUMNS),
        [
            Rule("exam_result", MISSING, R.is_missing_text("exam_result")),
            Rule("exam_result", INVALID, R.not_in_list("exam_result", EXAM_RESULTS)),
            Rule("obtained_marks_grade", INVALID, R.not_in_list("obtained_marks_grade", GRADES)),
        ],
    )


def error_log(frame: DataFrame, checks: Checked) -> DataFrame:
    """One row per broken rule, all rules in a single pass over the table.

    ``(source_table, original_row, column_name, issue_type, entity_key)``; the
    last column is for the key-based quarantine and is not part of the log table.

    The rules are unfolded first and the row text is built after, for broken
    rows only. A filter on "any rule broken" in front would not save work: it
    sinks below the typing of the columns and repeats that for every rule.
    """
    issues = F.array(*[
        F.when(rule.broken, F.struct(
            F.lit(rule.column_name).alias("column_name"), F.lit(rule.issue_type).alias("issue_type")
        ))
        for rule in checks.rules
    ])
    return (
        frame.select("*", F.inline(issues))
        .where("column_name IS NOT NULL")
        .select(
            F.lit(checks.source_table).alias("source_table"),
            checks.row.alias("original_row"),
            "column_name",
            "issue_type",
            F.col(checks.key).alias("entity_key"),
        )
    )


def error_log_by_union(frame: DataFrame, checks: Checked) -> DataFrame:
    """The same rows as ``error_log``, one branch and one scan per rule."""
    branches = [
        frame.where(rule.broken).select(
            F.lit(checks.source_table).alias("source_table"),
            checks.row.alias("original_row"),
            F.lit(rule.column_name).alias("column_name"),
            F.lit(rule.issue_type).alias("issue_type"),
            F.col(checks.key).alias("entity_key"),
        )
        for rule in checks.rules
    ]
    return reduce(DataFrame.unionByName, branches)
