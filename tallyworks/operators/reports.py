"""Grouped reports over the warehouse table, by course and batch.

Rows without the measured value are left out of a report. The tag that excludes
a course is a LIKE pattern: the first report drops courses that contain the
tag, the other two those that end in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions import records as R
from tallyworks.operators.ranking import first_per_group

CONTAINS_TAG = "%HPC%"
ENDS_IN_TAG = "%HPC"


def _attendance() -> Column:
    return R.attendance_number("avg_attendance_percent")


def average_attendance(warehouse: DataFrame) -> DataFrame:
    """``(course, batch, avg_attendance)``, rounded to two places."""
    return (
        warehouse.where(F.col("avg_attendance_percent").isNotNull())
        .groupBy("course", "batch")
        .agg(F.round(F.avg(_attendance()), 2).alias("avg_attendance"))
    )


def grade_counts(warehouse: DataFrame) -> DataFrame:
    """``(course, batch, obtained_grade, grade_count)``; rows without a grade are not counted."""
    return (
        warehouse.where(F.col("obtained_grade").isNotNull())
        .groupBy("course", "batch", "obtained_grade")
        .agg(F.count(F.lit(1)).alias("grade_count"))
    )


def mode_grade(warehouse: DataFrame) -> DataFrame:
    """``(course, batch, mode_grade)``: the most frequent grade, the smallest one among equals."""
    ranked = first_per_group(
        grade_counts(warehouse), ["course", "batch"], [F.desc("grade_count"), F.asc("obtained_grade")]
    )
    return ranked.select("course", "batch", F.col("obtained_grade").alias("mode_grade"))


def average_and_mode_by_join(warehouse: DataFrame, excluded: str = CONTAINS_TAG) -> DataFrame:
    """Report 1 as a join of its two halves; each half scans the table."""
    kept = warehouse.where(~F.col("course").like(excluded))
    return (
        average_attendance(kept)
        .join(mode_grade(kept), ["course", "batch"])
        .select("course", "batch", "avg_attendance", "mode_grade")
        .orderBy("course", "batch")
    )


def average_and_mode(warehouse: DataFrame, excluded: str = CONTAINS_TAG) -> DataFrame:
    """Report 1: ``(course, batch, avg_attendance, mode_grade)``, ordered by course and batch.

    One scan: sums and counts per grade are rolled up to both measures, in place
    of aggregating twice and joining. A group needs an attendance value and a
    grade to appear, and NULL in course or batch never appears, as in the join.
    """
    attendance = _attendance()
    per_grade = (
        warehouse.where(~F.col("course").like(excluded) & F.col("batch").isNotNull())
        .groupBy("course", "batch", "obtained_grade")
        .agg(
            F.sum(attendance).alias("total"),
            F.count(attendance).alias("n_attendance"),
            F.count("avg_attendance_percent").alias("n_given"),
            F.count("obtained_grade").alias("grade_count"),
        )
    )
    most_frequent = F.when(
        F.col("obtained_grade").isNotNull(), F.struct(-F.col("grade_count"), F.col("obtained_grade").alias("g"))
    )
    return (
        per_grade.groupBy("course", "batch")
        .agg(
            F.round(F.try_divide(F.sum("total"), F.sum("n_attendance")), 2).alias("avg_attendance"),
            F.min(most_frequent)["g"].alias("mode_grade"),
            F.sum("n_given").alias("n_given"),
        )
        .where((F.col("n_given") > 0) & F.col("mode_grade").isNotNull())
        .select("course", "batch", "avg_attendance", "mode_grade")
        .orderBy("course", "batch")
    )


def percentage_below(
    warehouse: DataFrame, excluded: str = ENDS_IN_TAG, threshold: float = 50.0
) -> DataFrame:
    """Report 2: share of rows with attendance under the threshold, among rows that have a value."""
    return (
        warehouse.where(F.col("avg_attendance_percent").isNotNull() & ~F.col("course").like(excluded))
        .groupBy("course", "batch")
        .agg(
            F.round(
                R.percentage(F.count(F.when(_attendance() < threshold, 1)), F.count(F.lit(1))), 2
            ).alias("percentage_below_50_attendance")
        )
        .orderBy("course", "batch")
    )


def top_courses(warehouse: DataFrame, excluded: str = ENDS_IN_TAG, k: int = 3) -> DataFrame:
    """Report 3: the ``k`` courses of each batch with the highest average attendance.

    Ranked on the exact average, equal averages by course name.
    """
    averages = (
        warehouse.where(F.col("avg_attendance_percent").isNotNull() & ~F.col("course").like(excluded))
        .groupBy("course", "batch")
        .agg(F.avg(_attendance()).alias("exact"))
    )
    return (
        first_per_group(averages, ["batch"], [F.desc("exact"), F.asc("course")], k)
        .select("course", "batch", F.round("exact", 2).alias("avg_attendance"), "rank")
        .orderBy("batch", "rank")
    )
