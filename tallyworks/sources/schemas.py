"""Declared schemas. Nothing is ever inferred from the data."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and order of the input extracts and tables.
ATTENDANCE_COLUMNS = [
    "course", "instructors", "name_hash", "email_hash", "member_id_hash",
    "classes_attended", "classes_absent", "avg_attendance_percent",
]
ENROLLMENT_COLUMNS = [
    "serial_no", "course", "status", "course_type", "course_variant", "academia_lms",
    "student_id", "student_name", "program", "batch", "period", "enrollment_date", "primary_faculty",
]
GRADE_ROSTER_COLUMNS = [
    "academy_location", "student_id", "student_status", "admission_id", "admission_status",
    "student_name", "program_code_name", "batch", "period", "subject_code_name", "course_type",
    "section", "faculty_name", "course_credit", "obtained_marks_grade", "out_of_marks_grade",
    "exam_result",
]
ERROR_COLUMNS = ["source_table", "original_row", "column_name", "issue_type"]
WAREHOUSE_SCHEMA = (
    "student_id string, student_name string, program string, batch string, course string, "
    "faculty array<string>, course_type string, period string, enrollment_date date, "
    "classes_attended int, classes_absent int, avg_attendance_percent decimal(5,2), "
    "obtained_grade string, total_marks string, exam_result string"
)
EXPORT_SCHEMA = (
    "student_id string, student_name string, program_name string, batch string, course string, "
    "instructor string, course_type string, term string, enrollment_date string, "
    "classes_attended int, classes_missed int, attendance float, "
    "grade_obtained string, max_grade string, status string"
)


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def grade_roster_schema() -> T.StructType:
    return T.StructType([
        T.StructField(name, T.IntegerType() if name == "course_credit" else T.StringType())
        for name in GRADE_ROSTER_COLUMNS
    ])
