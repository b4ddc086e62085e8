"""The library's inputs, derived from the star-schema and document tables under a data folder.

The extracts are given as text, as a CSV reader would return them, with defects
placed by key; the typing functions of ``sources.records`` then apply.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.sources import records, schemas
from tallyworks.sources.corpus import lines_of


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def roster(spark: SparkSession, folder: str) -> DataFrame:
    """A warehouse table: ``(student_id, program, batch, course, avg_attendance_percent, obtained_grade)``."""
    joined = (
        table(spark, folder, "lineitem")
        .join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    grade = F.concat("l_returnflag", (F.col("l_quantity").cast("int") % 3).cast("string"))
    return joined.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("student_id"),
        F.col("c_mktsegment").alias("program"),
        F.year("o_orderdate").cast("string").alias("batch"),
        F.col("p_brand").alias("course"),
        F.when(F.col("l_tax") > 0.075, None)
        .otherwise((F.col("l_quantity") * 2).cast("decimal(5,2)"))
        .alias("avg_attendance_percent"),
        F.when(F.col("l_discount") > 0.095, None).otherwise(grade).alias("obtained_grade"),
    )


def export(spark: SparkSession, folder: str) -> DataFrame:
    """The roster under the names of the export, with some student ids missing."""
    return roster(spark, folder).select(
        F.when(F.col("student_id") % 97 != 0, F.col("student_id").cast("string")).alias("student_id"),
        F.col("program").alias("program_name"),
        "batch",
        "course",
        F.col("avg_attendance_percent").cast("float").alias("attendance"),
        F.col("obtained_grade").alias("grade_obtained"),
    )


def _every(column: str, n: int) -> Column:
    return F.col(column) % n == 0


def _padded(column: str) -> Column:
    return F.concat(F.lit("S"), F.lpad(F.col(column).cast("string"), 9, "0"))


def _tagged(tag: str, value: Column) -> Column:
    return F.concat(F.lit(tag), value.cast("string"))


def attendance_text(spark: SparkSession, folder: str) -> DataFrame:
    percent = (F.col("l_quantity") * 2.04).cast("decimal(5,2)").cast("string")
    return (
        table(spark, folder, "lineitem")
        .select(
            F.when(_every("l_suppkey", 83), "").otherwise(_tagged("C", F.col("l_linenumber"))).alias("course"),
            F.when(_every("l_partkey", 37), "")
            .when(_every("l_partkey", 41), None)
            .otherwise(F.concat(_tagged("T", F.col("l_suppkey")), F.lit(", U"), F.col("l_linenumber").cast("string")))
            .alias("instructors"),
            _tagged("n", F.col("l_suppkey")).alias("name_hash"),
            F.when(_every("l_suppkey", 50), "bad")
            .when(_every("l_suppkey", 47), "")
            .otherwise(F.concat(
                F.md5(F.col("l_orderkey").cast("string").cast("binary")),
                F.md5(F.col("l_linenumber").cast("string").cast("binary")),
            ))
            .alias("email_hash"),
            F.when(_every("l_partkey", 101), "").otherwise(_padded("l_orderkey")).alias("member_id_hash"),
            F.when(_every("l_partkey", 29), "x")
            .otherwise(F.col("l_quantity").cast("int").cast("string")).alias("classes_attended"),
            F.col("l_linenumber").cast("string").alias("classes_absent"),
            F.when(_every("l_suppkey", 43), "1000.00%")
            .otherwise(F.concat(percent, F.lit("%"))).alias("avg_attendance_percent"),
        )
        .select(*schemas.ATTENDANCE_COLUMNS)
    )


def enrollment_text(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "orders")
        .select(
            F.col("o_orderkey").cast("string").alias("serial_no"),
            _tagged("C", F.lit(1) + F.col("o_orderkey") % 7).alias("course"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("course_type"),
            _tagged("V", F.col("o_custkey") % 3).alias("course_variant"),
            F.lit(None).cast("string").alias("academia_lms"),
            _padded("o_orderkey").alias("student_id"),
            _tagged("N", F.col("o_custkey")).alias("student_name"),
            _tagged("P", F.col("o_custkey") % 7).alias("program"),
            F.year("o_orderdate").cast("string").alias("batch"),
            _tagged("T", F.month("o_orderdate") % 3).alias("period"),
            F.when(_every("o_orderkey", 53), "")
            .when(_every("o_orderkey", 59), F.date_format("o_orderdate", "yyyy-MM-dd"))
            .otherwise(F.date_format("o_orderdate", "dd/MM/yy")).alias("enrollment_date"),
            F.concat(_tagged("F", F.col("o_custkey") % 11), F.lit(", G")).alias("primary_faculty"),
        )
        .select(*schemas.ENROLLMENT_COLUMNS)
    )


def grade_roster(spark: SparkSession, folder: str) -> DataFrame:
    """The grade roster, with exact duplicate rows."""
    values = {
        "academy_location": F.lit("L1"),
        "student_id": _padded("l_orderkey"),
        "student_status": F.col("l_linestatus"),
        "admission_id": _tagged("A", F.col("l_orderkey") % 10),
        "admission_status": F.lit("ok"),
        "student_name": F.lit(None).cast("string"),
        "program_code_name": _tagged("P", F.col("l_orderkey") % 7),
        "batch": _tagged("B", F.col("l_orderkey") % 4),
        "period": F.lit("T1"),
        "subject_code_name": _tagged("C", F.col("l_linenumber")),
        "course_type": F.lit("core"),
        "section": F.lit("s"),
        "faculty_name": F.lit("F"),
        "course_credit": F.col("l_linenumber").cast("int"),
        "obtained_marks_grade": F.when(_every("l_suppkey", 71), "Z")
        .when(F.col("l_returnflag") == "N", "b+ ")
        .when(F.col("l_returnflag") == "R", "F")
        .otherwise(F.col("l_returnflag")),
        "out_of_marks_grade": F.lit("A"),
        "exam_result": F.when(_every("l_partkey", 61), None)
        .when(_every("l_partkey", 67), "ABSENT")
        .when(_every("l_partkey", 73), "  ")
        .when(F.col("l_linestatus") == "O", " pass ")
        .otherwise("FAIL"),
    }
    return table(spark, folder, "lineitem").select(
        *[values[name].alias(name) for name in schemas.GRADE_ROSTER_COLUMNS]
    )


def attendance(spark: SparkSession, folder: str) -> DataFrame:
    return records.typed_attendance(attendance_text(spark, folder))


def enrollment(spark: SparkSession, folder: str) -> DataFrame:
    return records.typed_enrollment(enrollment_text(spark, folder))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text")


def corpus_lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines_of(documents(spark, folder))
