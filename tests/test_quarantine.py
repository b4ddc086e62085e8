"""Dropping entities with errors, by key and by text."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyworks.operators import quarantine
from tallyworks.operators.quarantine import keys_found_in_rows, quarantine_by_key, quarantine_by_text


def occurs(key, row):
    """Whether a key, read as a pattern, stands anywhere in a row: a backslash escapes a wildcard and is itself elsewhere."""
    out, i = "", 0
    while i < len(key):
        c = key[i]
        if c == "\\" and key[i + 1:i + 2] in ("%", "_"):
            i += 1
            out += re.escape(key[i])
        else:
            out += {"%": ".*", "_": "."}.get(c, re.escape(c))
        i += 1
    return re.search(out, row, re.S) is not None


def test_forms_differ_where_keys_overlap(spark):
    frame = spark.createDataFrame(
        [("S1",), ("S1",), ("S2",), ("S_2",), ("S",), ("",), (None,), ("zz",)], "id string"
    )
    errors = spark.createDataFrame([("c,S1,x", "S1"), ("c,SA2,x", "SA2")], "original_row string, entity_key string")
    assert sorted(r["id"] or "-" for r in quarantine_by_key(frame, "id", errors).collect()) == [
        "-", "S", "S2", "S_2", "zz"
    ]
    assert sorted(r["id"] or "-" for r in quarantine_by_text(frame, "id", errors).collect()) == ["-", "S2", "zz"]


def test_without_errors_everything_stays(spark):
    frame = spark.createDataFrame([("a",), ("",), (None,), ("_",)], "id string")
    errors = spark.createDataFrame([], "original_row string, entity_key string")
    assert quarantine_by_key(frame, "id", errors).count() == 4
    assert quarantine_by_text(frame, "id", errors).count() == 4


def test_escaped_wildcards_are_literal(spark):
    keys = ["a\\_", "\\_", "\\%", "\\\\_", "\\\\", "\\", "dom\\user", "a\\b%"]
    for rows in (["xa_"], ["ab"], ["c\\d"], ["c\\"], ["50%"], ["zz,dom\\user,1"], ["za\\b"], []):
        errors = spark.createDataFrame([(r,) for r in rows], "original_row string")
        found = keys_found_in_rows(spark.createDataFrame([(k,) for k in keys], "entity_key string"), errors)
        wanted = {k for k in keys if any(occurs(k, r) for r in rows)}
        assert {r["entity_key"] for r in found.collect()} == wanted


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.text("ab%_\\", max_size=5), min_size=1, max_size=40),
    st.lists(st.text("ab_%,\\", max_size=12), max_size=6),
)
def test_text_form_agrees_with_like(spark, keys, rows):
    errors = spark.createDataFrame([(r,) for r in rows], "original_row string")
    found = keys_found_in_rows(spark.createDataFrame([(k,) for k in keys], "entity_key string"), errors)
    wanted = {k for k in keys if any(occurs(k, r) for r in rows)}
    assert sorted(r["entity_key"] for r in found.collect()) == sorted(wanted)


@pytest.mark.parametrize("bits,pairs", [(None, 200_000), (1 << 14, 50)])
def test_a_thousand_wildcard_keys_with_one_common_part(spark, bits, pairs):
    """Every key begins with the same two letters, which stand in every row; common pieces are dealt to several tasks."""
    rows = [f"L,AB{i % 7}{i},name {i},a longer literal part {i % 50}" for i in range(0, 1500, 3)]
    keys = [f"AB_{i}" for i in range(1000)] + [f"longer literal part {i}" for i in range(60)] + ["AB%part", "%zzz%", "_", ""]
    found = quarantine.keys_found_in_rows(
        spark.createDataFrame([(k,) for k in keys], "entity_key string"),
        spark.createDataFrame([(r,) for r in rows], "original_row string").repartition(3), bits, pairs,
    )

    def like(key):
        pattern = re.compile("".join({"_": ".", "%": ".*"}.get(c, re.escape(c)) for c in key))
        return any(pattern.search(row) for row in rows)

    assert sorted(r[0] for r in found.collect()) == sorted(k for k in keys if like(k))


def test_common_pieces_are_split(spark):
    """One piece that stands in every row, for many keys: no salted part of it holds more than its share."""
    rows = spark.range(2000).selectExpr("concat('ABCDEFGHIJ', id) AS original_row")
    probes = spark.range(50).selectExpr(
        "concat('ABCDEFGHIJ%', id) AS entity_key", "array('ABCDEFGHIJ') AS literals"
    )
    chosen = quarantine.rarest_grams(probes, rows, 1 << 14).collect()
    assert {(r["gram"], r["df"]) for r in chosen} == {("ABCDEFGHIJ", 2000)}


def test_more_keys_than_the_filter_holds(spark, monkeypatch):
    """The filter that the driver hands out stays small however many keys there are, and goes on dropping pieces."""
    assert quarantine._filter_bits(10**9) <= 1 << 24
    monkeypatch.setattr(quarantine, "MOST_BITS", 1 << 14)
    rows = spark.range(4000).selectExpr("concat('row ', id, ',some,other,text,S', lpad(cast(id * 3 AS string), 9, '0')) AS original_row")
    keys = spark.range(9000).selectExpr("concat('S', lpad(cast(id AS string), 9, '0')) AS entity_key")
    pieces = quarantine.pieces_in(rows, keys.toDF("gram"), 1 << 14)
    assert pieces.count() < 8000
    found = keys_found_in_rows(keys.union(spark.sql("VALUES ('S00%2_7'), ('text,S00000'), ('text,S00001')")), rows)
    wanted = [f"S{i:09d}" for i in range(0, 9000, 3)] + ["S00%2_7", "text,S00000", "text,S00001"]
    assert sorted(r[0] for r in found.collect()) == sorted(wanted)
