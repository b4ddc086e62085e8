"""Skewed joins and the warehouse build."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyworks.operators.joins import hot_keys, salted_inner_join
from tallyworks.plans import standins, warehouse

FOLDER = "/root/testdata/sf0.001"


def rows(frame):
    return Counter(map(str, (tuple(r) for r in frame.collect())))


def test_hot_keys(spark):
    first = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2 + [(None,)] * 9, "k string")
    second = spark.createDataFrame([("a",)] + [("c",)] * 4, "k string")
    found = {r["k"]: (r["split"], r["salts"]) for r in hot_keys([first, second], ["k"], 3).collect()}
    assert found == {"a": (0, 2)}


def test_a_key_moderate_in_every_frame_is_hot(spark):
    frames = [spark.createDataFrame([("m",)] * n, "k string") for n in (10, 10, 1)]
    assert [tuple(r) for r in hot_keys(frames, ["k"], 50).collect()] == [("m", 0, 2)]
    assert hot_keys(frames, ["k"], 100).count() == 0


def test_every_hot_key_is_split(spark):
    """No list is too long: with 2,500 hot keys, each one is split."""
    frames = [spark.range(2500).selectExpr("id AS k").crossJoin(spark.range(4).select()) for _ in range(2)]
    found = hot_keys(frames, ["k"], 8)
    assert found.count() == 2500
    assert found.where("salts != 2").count() == 0


@pytest.mark.parametrize("hot_rows", [1, 4, 1000])
def test_salted_join_equals_plain_join(spark, hot_rows):
    """A third of the rows share one key, with exact copies among them; some keys have no partner."""
    sizes = [{"h": 60, "a": 3, "b": 1, "x": 2}, {"h": 5, "a": 20, "b": 1}, {"h": 3, "a": 2, "b": 30, "y": 1}]
    frames = []
    for i, size in enumerate(sizes):
        data = [(k, f"{k}{n % 7}") for k, count in size.items() for n in range(count)] + [(None, "none")]
        frames.append(spark.createDataFrame(data, f"k string, v{i} string").repartition(3, f"v{i}"))
    numbered = [f.withColumn(f"n{i}", F.xxhash64("k", f"v{i}")) for i, f in enumerate(frames)]
    salted = salted_inner_join(numbered, ["k"], ["n0", "n1", "n2"], hot_keys(frames, ["k"], hot_rows))
    plain = frames[0].join(frames[1], ["k"]).join(frames[2], ["k"])
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)
    assert sum(rows(salted).values()) == 60 * 5 * 3 + 3 * 20 * 2 + 30


def sources(spark):
    return (
        standins.attendance(spark, FOLDER), standins.enrollment(spark, FOLDER), standins.grade_roster(spark, FOLDER)
    )


def test_hot_students_do_not_change_the_warehouse(spark):
    attendance, enrollment, grades = sources(spark)
    usual = rows(warehouse.build_warehouse(attendance, enrollment, grades))
    assert usual
    assert usual == rows(warehouse.build_warehouse(attendance, enrollment, grades, hot_rows=2))
    assert usual == rows(warehouse.build_warehouse_by_text(attendance, enrollment, grades))
    by_text = warehouse.build_warehouse_by_text(attendance, enrollment, grades, hot_rows=2)
    assert usual == rows(by_text)


def test_join_of_sources_equals_plain_join(spark):
    attendance, enrollment, grades = sources(spark)
    plain = enrollment.join(
        attendance, (enrollment["student_id"] == attendance["member_id_hash"]) & (enrollment["course"] == attendance["course"])
    ).join(
        grades,
        (enrollment["student_id"] == grades["student_id"]) & (grades["subject_code_name"] == enrollment["course"]),
    )
    joined = warehouse.join_sources(enrollment, attendance, grades)
    assert joined.count() == plain.count() > 0
    hot = warehouse.hot_student_courses(enrollment, attendance, grades, hot_rows=1)
    assert rows(warehouse.join_sources(enrollment, attendance, grades, hot)) == rows(joined)


def test_one_bad_row_removes_the_student_everywhere(spark):
    attendance, enrollment, grades = sources(spark)
    student = warehouse.build_warehouse(attendance, enrollment, grades).first()["student_id"]
    broken = attendance.withColumn(
        "avg_attendance_percent",
        F.when(F.col("member_id_hash") == student, F.lit(120).cast("decimal(5,2)")).otherwise(
            F.col("avg_attendance_percent")
        ),
    )
    left = warehouse.build_warehouse(broken, enrollment, grades)
    assert left.where(F.col("student_id") == student).count() == 0
    assert left.count() > 0


def test_hot_keys_are_counted_once(spark):
    """The list of hot keys goes into three joins but is read once, beside the three narrow tables and the broken keys."""
    facts = warehouse.build_warehouse(*sources(spark), hot_rows=2)
    facts.collect()
    final = facts._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("ReusedExchange") >= 2
    assert final.count("FileScan") == 5
