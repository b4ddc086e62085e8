"""Reading, typing and checking the three extracts: one row for every edge."""

import datetime
import decimal

import pytest
from pyspark.sql import functions as F

from tallyworks.functions import records as R
from tallyworks.operators import quality
from tallyworks.sources import records

HASH = "ab" * 32
MEMBER = "0F" * 32

ATTENDANCE = f"""CS101,"A, B",n1,{HASH},{MEMBER},10,2,83.33%
,"A",n2,{HASH},{MEMBER},10,2,50%
CS101,"",n3,{HASH},{MEMBER},10,2,50%
CS101,"A",n4,,{MEMBER},10,2,50%
CS101,"A",n5,xyz,{MEMBER},10,2,50%
CS101,"A",n6,{HASH},,10,2,50%
CS101,"A",n7,{HASH},{MEMBER},10,2,120%
CS101,"A",n8,{HASH},{MEMBER},x,2,1000.00%
CS101,"A",n9,{HASH},{MEMBER},10,2,87.456%
"""


@pytest.fixture(scope="module")
def attendance_path(tmp_path_factory):
    folder = tmp_path_factory.mktemp("attendance")
    (folder / "part.csv").write_text(ATTENDANCE)
    return str(folder)


def by_name(frame):
    return {row["name_hash"]: row for row in frame.collect()}


def test_attendance_typing(spark, attendance_path):
    rows = by_name(records.read_attendance(spark, attendance_path))
    assert rows["n1"]["instructors"] == ["A", " B"]
    assert rows["n1"]["classes_attended"] == 10
    assert rows["n1"]["avg_attendance_percent"] == decimal.Decimal("83.33")
    assert rows["n2"]["course"] == ""
    assert rows["n3"]["instructors"] == [""]
    assert rows["n8"]["classes_attended"] is None
    assert rows["n8"]["avg_attendance_percent"] is None
    assert rows["n9"]["avg_attendance_percent"] == decimal.Decimal("87.46")


def issues(log):
    return sorted((r["original_row"].split(",n")[1][0], r["column_name"], r["issue_type"]) for r in log.collect())


EXPECTED = [
    ("2", "course", "Missing Value"),
    ("3", "instructors", "Missing Value"),
    ("4", "email_hash", "Invalid Format"),
    ("4", "email_hash", "Missing Value"),
    ("5", "email_hash", "Invalid Format"),
    ("6", "member_id_hash", "Missing Value"),
    ("7", "avg_attendance_percent", "Out of Range"),
]


@pytest.mark.parametrize("build", [quality.error_log, quality.error_log_by_union])
def test_attendance_rules(spark, attendance_path, build):
    log = build(records.read_attendance(spark, attendance_path), quality.attendance_checks())
    assert issues(log) == EXPECTED
    assert {r["source_table"] for r in log.collect()} == {"course_attendance"}


def test_blank_fields_read_as_null_break_one_rule_less(spark, attendance_path):
    frame = records.read_attendance(spark, attendance_path, blank_as="null")
    found = issues(quality.error_log(frame, quality.attendance_checks()))
    assert ("4", "email_hash", "Missing Value") in found
    assert ("4", "email_hash", "Invalid Format") not in found


def test_blank_as_is_checked(spark, attendance_path):
    with pytest.raises(ValueError):
        records.read_attendance(spark, attendance_path, blank_as="maybe")


def test_header_line_can_be_skipped(spark, tmp_path):
    (tmp_path / "a.csv").write_text("c,i,n,e,m,a,b,p\nCS,A,n1,e,m,1,2,3%\n")
    assert records.read_attendance(spark, str(tmp_path)).count() == 2
    assert records.read_attendance(spark, str(tmp_path), header=True).count() == 1


def test_enrollment_dates(spark):
    values = ["05/08/24", "05/08/99", "5/8/24", "05/08/2024", "31/02/24", "", None]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, enrollment_date string")
    parsed = [r["d"] for r in frame.select(R.short_date("enrollment_date").alias("d")).collect()]
    assert parsed == [datetime.date(2024, 8, 5), datetime.date(2099, 8, 5)] + [None] * 5
    missing, invalid = quality.enrollment_checks().rules
    flags = [
        (bool(r["m"]), bool(r["b"]))
        for r in frame.select(missing.broken.alias("m"), invalid.broken.alias("b")).collect()
    ]
    assert flags == [
        (False, False), (False, False), (False, True), (False, True), (False, True), (True, True), (True, False)
    ]


def test_enrollment_file(spark, tmp_path):
    (tmp_path / "e.csv").write_text('7,C1,ok,core,v,,S1,Ann,P,2024,T1,05/08/24,"F, G"\nx,C1,ok,core,v,l,S2,Bo,P,2024,T1,,F\n')
    first, second = records.read_enrollment(spark, str(tmp_path)).orderBy("student_id").collect()
    assert (first["serial_no"], first["primary_faculty"], first["academia_lms"]) == (7, ["F", " G"], "")
    assert (second["serial_no"], second["enrollment_date"]) == (None, "")


def grade_line(exam, grade, credit="4"):
    return ",".join(["L", "S1", "in", "A1", "ok", '"Ann"', "P", "B", "T", "C1", "core", "s", "F", credit, grade, "A", exam])


def test_grade_roster(spark, tmp_path):
    lines = [
        grade_line("pass ", "a-"), grade_line("", "A"), grade_line("   ", "A"), grade_line("ABSENT", "A+", "x"),
        grade_line("FAIL", ""), grade_line("FAIL", "") + ",surplus", "L,S2,in",
    ]
    (tmp_path / "g.csv").write_text("\n".join(lines) + "\n")
    frame = records.read_grade_roster(spark, str(tmp_path))
    rows = frame.collect()
    assert rows[0]["student_name"] == '"Ann"'  # no quoting in this format
    assert rows[1]["exam_result"] is None
    assert rows[3]["course_credit"] is None and rows[3]["exam_result"] == "ABSENT"
    assert rows[4] == rows[5]
    assert rows[6]["student_status"] == "in" and rows[6]["exam_result"] is None
    log = quality.error_log(frame.where("student_id = 'S1'"), quality.grade_roster_checks())
    found = sorted((r["column_name"], r["issue_type"]) for r in log.collect())
    assert found == [
        ("exam_result", "Invalid Format"),
        ("exam_result", "Invalid Format"),
        ("exam_result", "Missing Value"),
        ("exam_result", "Missing Value"),
        ("obtained_marks_grade", "Invalid Format"),
    ]


def test_row_text_skips_null_fields(spark):
    frame = spark.createDataFrame([("a", None, "c", ["x", "y"])], "a string, b string, c string, l array<string>")
    text = frame.select(R.row_text("a", "b", "c", R.joined_list("l")).alias("t")).first()["t"]
    assert text == "a,c,x;y"


def test_attendance_number_accepts_text_and_decimals(spark):
    frame = spark.sql("SELECT '87.5%' AS t, CAST(87.5 AS DECIMAL(5,2)) AS d, 'n/a' AS b")
    row = frame.select(*[R.attendance_number(c).alias(c) for c in "tdb"]).first()
    assert tuple(row) == (87.5, 87.5, None)


def test_percentage_of_nothing_is_null(spark):
    frame = spark.range(1).select(R.percentage(F.lit(0), F.lit(0)).alias("p"))
    assert frame.first()["p"] is None


def test_export_is_read_by_position(spark, tmp_path):
    (tmp_path / "x").write_text("S1,Ann,P,2024,C1,A;B,core,T,2024-08-05,10,2,83.33,A,A,PASS\nS2,Bo,P,2024,C1,A,core,T,d,x,2\n")
    first, second = records.read_warehouse_export(spark, str(tmp_path)).orderBy("student_id").collect()
    assert first["instructor"] == "A;B" and first["status"] == "PASS"
    assert first["attendance"] == pytest.approx(83.33, abs=1e-5)
    assert second["classes_attended"] is None and second["attendance"] is None
