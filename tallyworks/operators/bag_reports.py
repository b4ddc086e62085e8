"""The reports in their second form, by course and program, over the warehouse export.

Same questions, other rules about missing values than in ``reports``: a row
without attendance stays in the denominator, rows without a grade form a group
of their own that may be the mode, rows without a student id are not counted,
and averages are not rounded.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions import records as R
from tallyworks.operators.ranking import first_per_group

TAG_PATTERN = ".*HPC.*"
GROUP = ["course", "program_name"]


def without_matching(raw: DataFrame, pattern: str = TAG_PATTERN) -> DataFrame:
    """Drop courses that the pattern matches in full; rows without a course go too."""
    return raw.where(~F.col("course").rlike(f"^(?:{pattern})$"))


def average_attendance(cleaned: DataFrame, name: str = "avg_attendance") -> DataFrame:
    return cleaned.groupBy(*GROUP).agg(F.avg("attendance").alias(name))


def grade_counts(cleaned: DataFrame) -> DataFrame:
    return cleaned.groupBy(*GROUP, "grade_obtained").agg(F.count("student_id").alias("grade_count")).select(
        *GROUP, F.col("grade_obtained").alias("obtained_grade"), "grade_count"
    )


def _grade_order() -> list[Column]:
    return [F.desc("grade_count"), F.asc_nulls_first("obtained_grade")]


def mode_bags(counts: DataFrame) -> DataFrame:
    """Per group the most frequent grade, each field as a bag (an array of one)."""
    top = first_per_group(counts, GROUP, _grade_order())
    return top.select(
        F.array("course").alias("course"),
        F.array("program_name").alias("program_name"),
        F.array("obtained_grade").alias("mode_grade"),
    )


def flatten(frame: DataFrame, *bags: str) -> DataFrame:
    """Un-nest array columns one after the other: several bags give their cross product."""
    for bag in bags:
        frame = frame.withColumn(bag, F.explode(bag))
    return frame


def mode_grade(cleaned: DataFrame) -> DataFrame:
    top = first_per_group(grade_counts(cleaned), GROUP, _grade_order())
    return top.select(*GROUP, F.col("obtained_grade").alias("mode_grade"))


def average_and_mode(cleaned: DataFrame) -> DataFrame:
    """Report 1: ``(course, program_name, avg_attendance, mode_grade)``. NULL keys find no partner."""
    return average_attendance(cleaned).join(mode_grade(cleaned), GROUP).select(
        *GROUP, "avg_attendance", "mode_grade"
    )


def percentage_below(cleaned: DataFrame, threshold: float = 50.0) -> DataFrame:
    """Report 2: ``(course, program_name, percentage_below_50_attendance)``, ordered."""
    below = F.count(F.when(F.col("attendance") < threshold, F.col("student_id")))
    return (
        cleaned.groupBy(*GROUP)
        .agg(R.percentage(below, F.count("student_id")).alias("percentage_below_50_attendance"))
        .orderBy(*GROUP)
    )


def top_courses(cleaned: DataFrame, k: int = 3) -> DataFrame:
    """Report 3: the ``k`` courses of each program with the highest average attendance."""
    averages = average_attendance(cleaned, "average_attendance")
    order = [F.desc_nulls_last("average_attendance"), F.asc("course")]
    return first_per_group(averages, ["program_name"], order, k).select(*GROUP, "average_attendance")


def top_course_bags(cleaned: DataFrame, k: int = 3) -> DataFrame:
    """The same with one bag per field and program. A bag holds at most ``k`` entries."""
    averages = average_attendance(cleaned, "average_attendance")
    order = [F.desc_nulls_last("average_attendance"), F.asc("course")]
    best = first_per_group(averages, ["program_name"], order, k)
    rows = F.array_sort(F.collect_list(F.struct("rank", *GROUP, "average_attendance")))
    return best.groupBy(F.col("program_name").alias("program")).agg(rows.alias("rows")).select(
        F.col("rows.course").alias("course"),
        F.col("rows.program_name").alias("program_name"),
        F.col("rows.average_attendance").alias("average_attendance"),
    )


def top_courses_crossed(cleaned: DataFrame, k: int = 3) -> DataFrame:
    """Report 3 with every field of the bags flattened on its own: up to ``k**3`` rows a program."""
    return flatten(top_course_bags(cleaned, k), "course", "program_name", "average_attendance")


class BagReports(NamedTuple):
    average_and_mode: DataFrame
    percentage_below: DataFrame
    top_courses: DataFrame


def summary(cleaned: DataFrame) -> DataFrame:
    """Sums and counts per course, program and grade, enough for all three reports."""
    return cleaned.groupBy(*GROUP, "grade_obtained").agg(
        F.sum("attendance").alias("total"),
        F.count("attendance").alias("n_attendance"),
        F.count(F.when(F.col("attendance") < 50.0, F.col("student_id"))).alias("n_below"),
        F.count("student_id").alias("n_students"),
    )


def all_reports(summed: DataFrame) -> BagReports:
    """The three reports from one ``summary``.

    The export is read once for all three when the caller writes or caches the
    summary, which is small; each report then works on the summed rows.
    """
    average = F.try_divide(F.sum("total"), F.sum("n_attendance"))
    best = F.min(F.struct(-F.col("n_students"), F.col("grade_obtained").alias("g")))["g"]
    averages = summed.groupBy(*GROUP).agg(average.alias("average_attendance"))
    order = [F.desc_nulls_last("average_attendance"), F.asc("course")]
    return BagReports(
        summed.groupBy(*GROUP)
        .agg(average.alias("avg_attendance"), best.alias("mode_grade"))
        .where(F.col("course").isNotNull() & F.col("program_name").isNotNull()),
        summed.groupBy(*GROUP)
        .agg(
            R.percentage(F.sum("n_below"), F.sum("n_students")).alias("percentage_below_50_attendance")
        )
        .orderBy(*GROUP),
        first_per_group(averages, ["program_name"], order, 3).select(*GROUP, "average_attendance"),
    )
