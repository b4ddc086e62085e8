"""Word co-occurrence within a distance, as pairs and as stripes (one map per word).

Two words of one line co-occur at distance ``d`` when their slots differ by 1
to ``d``. Words outside the vocabulary are not counted but keep their slot.

Everything rests on one count, taken left to right only: how often ``neighbor``
stands exactly ``gap`` slots after ``word``. Mirroring it, and summing it over
gaps, happens on the counts, which are at most ``d`` times the square of the
vocabulary.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.functions import text as T
from tallyworks.operators.filters import bit_places, bloom_filter
from tallyworks.operators.words import keep_listed

LOCAL_AGGREGATIONS = ("none", "line", "task")
STRIPE_PARTS = 8
FILTER_BITS = 1 << 15      # of the vocabulary's filter when pairs are counted by line; it decides about speed only


def _check(distance: int, local_agg: str) -> None:
    if distance < 1:
        raise ValueError(f"distance must be at least 1, not {distance}")
    if local_agg not in LOCAL_AGGREGATIONS:
        raise ValueError(f"local_agg must be one of {LOCAL_AGGREGATIONS}, not {local_agg!r}")


def gap_occurrences(lines: DataFrame, vocabulary: DataFrame, distance: int, line: str = "line") -> DataFrame:
    """``(word, gap, neighbor)``, one row per occurrence, ``neighbor`` to the right of ``word``.

    Each slot is laid beside the ``distance`` slots after it. Slots whose own
    word is not listed go before their neighbours are unfolded.
    """
    slots = lines.select(T.letter_slots(line).alias("w0"))
    n_slots = F.greatest(F.size("w0"), F.lit(1))
    shifted = [F.slice("w0", gap + 1, n_slots).alias(f"w{gap}") for gap in range(1, distance + 1)]
    side_by_side = F.arrays_zip(*[f"w{gap}" for gap in range(distance + 1)])
    windows = slots.select("w0", *shifted).select(F.inline(side_by_side))
    listed = keep_listed(windows.where("w0 != ''"), "w0", vocabulary)
    neighbors = F.array(*[
        F.struct(F.lit(gap).alias("gap"), F.col(f"w{gap}").alias("neighbor")) for gap in range(1, distance + 1)
    ])
    pairs = listed.select(F.col("w0").alias("word"), F.inline(neighbors)).where("neighbor != ''")
    return keep_listed(pairs, "neighbor", vocabulary)


def gap_counts(
    lines: DataFrame,
    vocabulary: DataFrame,
    distance: int,
    line: str = "line",
    local_agg: str = "task",
) -> DataFrame:
    """``(gap, word, neighbor, n)`` for gaps 1 to ``distance``.

    ``local_agg="line"`` counts within each line first. ``"task"`` and
    ``"none"`` are one plan: Spark aggregates within a task before it shuffles.
    """
    _check(distance, local_agg)
    if local_agg == "line":
        return _gap_counts_by_line(lines, vocabulary, distance, line)
    occurrences = gap_occurrences(lines, vocabulary, distance, line)
    return occurrences.groupBy("gap", "word", "neighbor").agg(F.count(F.lit(1)).alias("n"))


def _gap_counts_by_line(lines: DataFrame, vocabulary: DataFrame, distance: int, line: str) -> DataFrame:
    """``gap_counts`` with the pairs of a line counted inside the line.

    No shuffle before the counts are summed. Which words are listed is first asked of a Bloom filter, a few
    kilobytes whatever the size of the vocabulary, and then, for the counted pairs, of the vocabulary itself by joins. In the
    ordered slots that pass, the neighbours of a word are among the next ``distance`` entries. The pairs of the line are
    sorted in their array and counted by run length.
    """
    listed = vocabulary.toDF("_listed")
    slots = lines.select(T.letter_slots(line).alias("slots"), bloom_filter(listed, "_listed", FILTER_BITS).alias("_filter"))
    placed = F.transform("slots", lambda w, i: F.struct(
        i.alias("slot"), w.alias("word"), *[at.alias(f"at{k}") for k, at in enumerate(bit_places(w, FILTER_BITS))]
    ))
    held = " AND ".join(f"shiftrightunsigned(_filter[CAST(p.at{k} >> 6 AS INT)], CAST(p.at{k} & 63 AS INT)) & 1L = 1" for k in (0, 1))
    gathered = slots.select("_filter", placed.alias("s")).select(F.expr(f"filter(s, p -> p.word != '' AND {held})").alias("s"))
    following = [
        f"zip_with(s, slice(s, {o} + 1, size(s)), (a, b) -> if(b.slot - a.slot <= {distance},"
        " struct(b.slot - a.slot AS gap, a.word AS word, b.word AS neighbor), NULL))"
        for o in range(1, distance + 1)
    ]
    pairs = gathered.select(F.expr(f"sort_array(filter(concat({', '.join(following)}), p -> p IS NOT NULL))").alias("ps"))
    ends = "filter(transform(ps, (p, i) -> if(p <=> get(ps, i + 1), -1, i)), i -> i >= 0)"
    runs = "transform(ends, (e, i) -> struct(ps[e] AS p, CAST(e - coalesce(get(ends, i - 1), -1) AS LONG) AS n))"
    # Not plain ``inline``: for that, Spark would filter by the size of the array and compute it once more for it.
    counted = pairs.select("ps", F.expr(ends).alias("ends")).select(F.inline_outer(F.expr(runs))).where("p IS NOT NULL")
    counts = counted.select("p.*", "n").groupBy("gap", "word", "neighbor").agg(F.sum("n").alias("n"))
    return keep_listed(keep_listed(counts, "word", vocabulary), "neighbor", vocabulary)


def mirrored(counts: DataFrame) -> DataFrame:
    """Both directions of left-to-right counts; a pair of equal words counts twice."""
    both = F.array(
        F.struct(F.col("word"), F.col("neighbor")),
        F.struct(F.col("neighbor").alias("word"), F.col("word").alias("neighbor")),
    )
    others = [c for c in counts.columns if c not in ("word", "neighbor")]
    return counts.select(*others, F.inline(both))


def cooccurrence_pairs(
    lines: DataFrame,
    vocabulary: DataFrame,
    distance: int = 1,
    line: str = "line",
    local_agg: str = "task",
) -> DataFrame:
    """``(word, neighbor, n)`` within ``distance``."""
    counts = gap_counts(lines, vocabulary, distance, line, local_agg)
    return mirrored(counts).groupBy("word", "neighbor").agg(F.sum("n").alias("n"))


def distance_sweep(
    lines: DataFrame,
    vocabulary: DataFrame,
    max_distance: int = 4,
    line: str = "line",
    local_agg: str = "task",
) -> DataFrame:
    """``(d, word, neighbor, n)`` for every distance 1 to ``max_distance``, from one pass.

    A gap counts for every distance at least as large.
    """
    counts = mirrored(gap_counts(lines, vocabulary, max_distance, line, local_agg))
    distances = F.sequence(F.col("gap"), F.lit(max_distance))
    return (
        counts.withColumn("d", F.explode(distances))
        .groupBy("d", "word", "neighbor")
        .agg(F.sum("n").alias("n"))
    )


def stripe_parts(pairs: DataFrame, parts: int = STRIPE_PARTS) -> DataFrame:
    """``(word, part, stripe)``: the map of a word cut by the hash of the neighbour, for vocabularies of any size."""
    part = F.pmod(F.xxhash64("neighbor"), F.lit(parts)).cast("int")
    return pairs.groupBy("word", part.alias("part")).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("neighbor", "n")))).alias("stripe")
    )


def stripes(pairs: DataFrame, parts: int = STRIPE_PARTS) -> DataFrame:
    """``(word, stripe)``: one map per word, neighbour to count, built from finished pair counts.

    A map is built in ``parts`` parts, each in a task of its own, and merged last: what one task gathers
    entry by entry is a part, and what it merges is the finished map. A map that may be larger than
    a task stays in its parts, see ``stripe_parts``.
    """
    built = stripe_parts(pairs, parts).select("word", F.map_entries("stripe").alias("entries"))
    entries = F.array_sort(F.flatten(F.collect_list("entries")))
    return built.groupBy("word").agg(F.map_from_entries(entries).alias("stripe"))


def unstriped(striped: DataFrame) -> DataFrame:
    """Back from maps to ``(word, neighbor, n)``."""
    return striped.select("word", F.explode("stripe").alias("neighbor", "n"))
