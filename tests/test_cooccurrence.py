"""Co-occurrence against a plain count over positions, and its invariants."""

import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyworks.operators import cooccurrence as co
from tallyworks.plans import catalogue, standins
from tallyworks.sinks.text import map_text

FOLDER = "/root/testdata/sf0.001"


def plain_pairs(lines, vocabulary, distance):
    counts = Counter()
    for line in lines:
        tokens = [re.sub("[^a-zA-Z]", "", t).lower() for t in re.split(r"\s+", line)]
        for i, a in enumerate(tokens):
            for j, b in enumerate(tokens):
                if 0 < abs(i - j) <= distance and a in vocabulary and b in vocabulary:
                    counts[a, b] += 1
    return dict(counts)


def frames(spark, lines, vocabulary):
    return (
        spark.createDataFrame([(x,) for x in lines], "line string"),
        spark.createDataFrame([(x,) for x in vocabulary], "word string"),
    )


def as_dict(pairs):
    return {(r["word"], r["neighbor"]): r["n"] for r in pairs.collect()}


@pytest.mark.parametrize("line, distance, expected", [
    ("war 2010 world", 1, {}),
    ("war 2010 world", 2, {("war", "world"): 1, ("world", "war"): 1}),
    ("quot quot quot", 1, {("quot", "quot"): 4}),
    ("quot quot quot", 2, {("quot", "quot"): 6}),
    ("states united", 1, {("states", "united"): 1, ("united", "states"): 1}),
    ("  War, WORLD ", 1, {("war", "world"): 1, ("world", "war"): 1}),
    ("", 1, {}),
])
@pytest.mark.parametrize("local_agg", ["none", "line", "task"])
def test_fixtures(spark, line, distance, expected, local_agg):
    pairs = co.cooccurrence_pairs(
        *frames(spark, [line], ["war", "world", "quot", "states", "united", "2010"]), distance, local_agg=local_agg
    )
    assert as_dict(pairs) == expected


def test_no_pairs_across_lines(spark):
    assert as_dict(co.cooccurrence_pairs(*frames(spark, ["war", "world"], ["war", "world"]))) == {}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.lists(st.sampled_from(["a", "B,", "c", "zz", "9", "--", " ", "a.b"]), max_size=14).map(" ".join), min_size=1, max_size=6),
    st.integers(1, 6),
)
def test_agrees_with_plain_count(spark, lines, distance):
    vocabulary = ["a", "b", "c", "ab"]
    wanted = plain_pairs(lines, vocabulary, distance)
    inputs = frames(spark, lines, vocabulary)
    assert as_dict(co.cooccurrence_pairs(*inputs, distance)) == wanted
    assert as_dict(co.cooccurrence_pairs(*inputs, distance, local_agg="line")) == wanted
    sweep = co.distance_sweep(*inputs, distance).where(f"d = {distance}")
    assert as_dict(sweep) == wanted


def test_invariants_on_the_given_documents(spark):
    sweep = catalogue.cooc_distance_sweep(spark, FOLDER).collect()
    n = {(r["d"], r["word"], r["neighbor"]): r["n"] for r in sweep}
    assert n
    for (d, a, b), count in n.items():
        assert n[d, b, a] == count
        assert a != b or count % 2 == 0
        assert d == catalogue.MAX_DISTANCE or n[d + 1, a, b] >= count


def test_hot_line_and_long_line(spark):
    """One text repeated many times, and one line of a whole document's length."""
    lines = ["the of the"] * 500 + [" ".join(["the", "x", "of"] * 4000)]
    wanted = plain_pairs(lines[:1], ["the", "of"], 2)
    inputs = frames(spark, lines, ["the", "of"])
    found = as_dict(co.cooccurrence_pairs(*inputs, 2))
    assert found == as_dict(co.cooccurrence_pairs(*inputs, 2, local_agg="line"))
    assert found["the", "the"] == 500 * wanted["the", "the"]
    assert found["the", "of"] == 500 * wanted["the", "of"] + 4000 + 3999


def test_stripes_hold_the_pairs(spark):
    inputs = (standins.corpus_lines(spark, FOLDER), catalogue._vocabulary(spark, FOLDER))
    pairs = co.cooccurrence_pairs(*inputs, 3)
    striped = co.stripes(pairs)
    assert as_dict(co.unstriped(striped)) == as_dict(pairs)
    assert striped.count() == len({a for a, _ in as_dict(pairs)})


def test_stripe_text(spark):
    frame = spark.sql("SELECT map('b', 2L, 'a', 1L) AS m")
    assert frame.select(map_text(frame["m"])).first()[0] == "{a=1, b=2}"


@pytest.mark.parametrize("arguments", [{"distance": 0}, {"local_agg": "2"}])
def test_parameters_are_checked(spark, arguments):
    with pytest.raises(ValueError):
        co.cooccurrence_pairs(*frames(spark, ["a"], ["a"]), **arguments)


def test_line_aggregation_with_a_vocabulary_of_twenty_thousand_words(spark):
    def word(i):  # letters only
        return "w" + "".join(chr(97 + int(d)) for d in str(i))

    lines = spark.createDataFrame(
        [(" ".join([word(i), "unlisted", word(i + 1), word(i), ".", word(2 * i)]),) for i in range(0, 30_000, 60)], "line string"
    )
    vocabulary = spark.createDataFrame([(word(i),) for i in range(20_000)], "word string")
    found, plain = (
        {tuple(r) for r in co.gap_counts(lines, vocabulary, 3, local_agg=how).select("gap", "word", "neighbor", "n").collect()}
        for how in ("line", "none")
    )
    assert found == plain and len(found) > 1000


def test_stripes_in_parts_are_whole(spark):
    pairs = spark.range(20_000).selectExpr("'hot' AS word", "concat('n', id) AS neighbor", "id AS n")
    assert co.stripe_parts(pairs).count() == co.STRIPE_PARTS
    striped = co.stripes(pairs)
    assert striped.count() == 1
    assert {tuple(r) for r in co.unstriped(striped).collect()} == {("hot", f"n{i}", i) for i in range(20_000)}
