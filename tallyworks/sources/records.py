"""Readers for the delimited extracts, and their lenient typing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyworks.functions import records as R
from tallyworks.sources import schemas


def read_quoted_csv(
    spark: SparkSession, path: str, columns: list[str], header: bool = False, blank_as: str = "empty"
) -> DataFrame:
    """Comma-separated text with ``"`` quotes and backslash escapes, every field as text.

    Empty fields come back as ``''`` (``blank_as="empty"``) or as NULL (``"null"``).
    """
    if blank_as not in ("empty", "null"):
        raise ValueError(f"blank_as must be 'empty' or 'null', not {blank_as!r}")
    frame = (
        spark.read.schema(schemas.text_schema(columns))
        .options(sep=",", quote='"', escape="\\", header=header, mode="PERMISSIVE")
        .csv(path)
    )
    return frame.na.fill("") if blank_as == "empty" else frame


def read_plain_csv(spark: SparkSession, path: str, schema, header: bool = False) -> DataFrame:
    """Comma-separated text without quoting. Empty or untypable fields and missing
    trailing fields are NULL; surplus fields are dropped."""
    return (
        spark.read.schema(schema)
        .options(sep=",", quote="", nullValue="", header=header, mode="PERMISSIVE")
        .csv(path)
    )


def read_attendance(spark: SparkSession, path: str, **options) -> DataFrame:
    return typed_attendance(read_quoted_csv(spark, path, schemas.ATTENDANCE_COLUMNS, **options))


def read_enrollment(spark: SparkSession, path: str, **options) -> DataFrame:
    return typed_enrollment(read_quoted_csv(spark, path, schemas.ENROLLMENT_COLUMNS, **options))


def read_grade_roster(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    return read_plain_csv(spark, path, schemas.grade_roster_schema(), header)


def read_warehouse_export(spark: SparkSession, path: str) -> DataFrame:
    return read_plain_csv(spark, path, schemas.EXPORT_SCHEMA)


def typed_attendance(raw: DataFrame) -> DataFrame:
    return raw.select(
        "course", "name_hash", "email_hash", "member_id_hash",
        R.to_int("classes_attended").alias("classes_attended"),
        R.to_int("classes_absent").alias("classes_absent"),
        R.split_list("instructors").alias("instructors"),
        R.percent_to_decimal("avg_attendance_percent").alias("avg_attendance_percent"),
    )


def typed_enrollment(raw: DataFrame) -> DataFrame:
    return raw.select(
        R.to_int("serial_no").alias("serial_no"),
        *schemas.ENROLLMENT_COLUMNS[1:-1],
        R.split_list("primary_faculty").alias("primary_faculty"),
    )
