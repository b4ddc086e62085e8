"""Dropping every row of an entity that occurs in the error log.

Two forms. ``quarantine_by_key`` compares keys and is the one to use at scale.
``quarantine_by_text`` asks whether the key, read as a LIKE pattern, occurs
anywhere inside a logged row; it also drops rows whose key merely appears within
another value, and lets ``%`` and ``_`` in keys act as wildcards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.operators.filters import bit_places, bloom_filter
from tallyworks.sinks import tables

GRAM = 10                  # longest piece of a key that is looked up
BITS_A_GRAM = 16
LEAST_BITS, MOST_BITS = 1 << 14, 1 << 24    # of a filter; the larger one is 2 MB, in the driver and in each task
PAIRS = 200_000            # key and row pairs of one gram that one task verifies


def with_empty_key(keys: DataFrame) -> DataFrame:
    """The distinct keys, and the empty key as soon as there is any error at all:
    an empty key occurs inside every logged row."""
    both = F.explode(F.array(F.col("entity_key"), F.lit("")))
    return keys.select(both.alias("entity_key")).distinct()


def quarantine_by_key(frame: DataFrame, key: str, errors: DataFrame) -> DataFrame:
    """Keep rows whose key has no entry in ``errors.entity_key``. Rows without a key stay."""
    bad = with_empty_key(errors.select("entity_key"))
    return frame.join(bad, frame[key] == bad["entity_key"], "left_anti")


def _probes(keys: DataFrame) -> DataFrame:
    """``(entity_key, wild, literals, pattern, any_chars)``: each distinct key and the literal parts between its wildcards."""
    # A backslash escapes a wildcard that follows it and is itself anywhere else.
    wildcard = F.col("entity_key").rlike(r"(?<!\\)[%_]")
    runs = F.regexp_extract_all("entity_key", F.lit(r"((?:\\[%_]|[^%_])+)"), 1)
    return keys.select("entity_key").where(F.col("entity_key").isNotNull()).distinct().select(
        "entity_key",
        wildcard.alias("wild"),
        F.filter(F.transform(runs, lambda run: F.regexp_replace(run, r"\\([%_])", "$1")), lambda p: p != "").alias("literals"),
        F.regexp_replace("entity_key", r"\\(?![%_])", r"\\\\").alias("pattern"),
        (F.length("entity_key") - F.length(F.replace("entity_key", F.lit("_"), F.lit("")))).alias("any_chars"),
    )


def _grams_of(part: Column) -> Column:
    """The pieces of ``GRAM`` characters of a literal part; a shorter part is one piece."""
    return F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(part) - GRAM + 1, F.lit(1))), lambda i: F.substring(part, i, F.lit(GRAM))
    )


def _head_length(grams: DataFrame, bits: int) -> int:
    """How many first characters of the grams a filter of ``bits`` holds: all of them, unless it is at its largest
    and the grams are too many. Heads are fewer, and a filter that is full of whole grams would let every piece pass."""
    if bits < MOST_BITS:
        return GRAM
    counts = grams.agg(*[F.approx_count_distinct(F.left("gram", F.lit(n))) for n in range(1, GRAM + 1)]).first()
    return max((n for n, heads in enumerate(counts, 1) if heads * BITS_A_GRAM <= bits), default=1)


def pieces_in(rows: DataFrame, grams: DataFrame, bits: int, *keep: str) -> DataFrame:
    """``(piece, *keep)``: the pieces of ``rows.original_row`` that may be among ``grams(gram)``, one row per place.

    Every piece of the lengths that occur among the grams is tested against a filter of the grams where it is cut, so
    that only few others go on to a shuffle. If the filter cannot hold all grams, it holds as long a beginning of each as it can.
    """
    # One entry per distinct length, at most GRAM of them.
    lengths = grams.agg(F.collect_set(F.length("gram"))).scalar()
    head = F.lit(_head_length(grams, bits))
    words = bloom_filter(grams.select(F.left("gram", head).alias("head")), "head", bits)
    carried = dict.fromkeys(["original_row", *keep])
    cut = (
        rows.select(*carried, F.explode(lengths).alias("_n"))
        .where(F.length("original_row") >= F.col("_n"))
        .select(*carried, "_n", F.explode(F.expr("sequence(1, length(original_row) - _n + 1)")).alias("_i"))
        .select(*keep, F.expr("substring(original_row, _i, _n)").alias("piece"))
    )

    def held(at: Column) -> Column:
        # the filter stays a constant of the expression; as a column it would be copied into every row
        word, bit = F.get(words, F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftrightunsigned", word, bit).bitwiseAND(F.lit(1)) == 1

    first, second = bit_places(F.left("piece", head), bits)
    return cut.where(held(first) & held(second)).select("piece", *keep)


def _filter_bits(grams: int) -> int:
    """Filter size for a number of grams, a power of two. It decides about speed only."""
    return min(max(1 << (grams * BITS_A_GRAM).bit_length(), LEAST_BITS), MOST_BITS)


def rarest_grams(probes: DataFrame, rows: DataFrame, bits: int) -> DataFrame:
    """``(entity_key, gram, df)``: for each key that has several grams the one found in the fewest places of ``rows``.

    Keys with a gram that is found nowhere are left out: they occur in no row.
    """
    grams = probes.select("entity_key", F.explode(F.array_distinct(F.flatten(F.transform("literals", _grams_of)))).alias("gram"))
    counts = pieces_in(rows, grams.select("gram").distinct(), bits).groupBy("piece").agg(F.count(F.lit(1)).alias("df"))
    ranked = grams.join(counts, F.col("gram") == F.col("piece"), "left")
    least = ranked.groupBy("entity_key").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "gram")).alias("least"))
    return least.where("least.df > 0").select("entity_key", F.col("least.gram").alias("gram"), F.col("least.df").alias("df"))


def keys_found_in_rows(keys: DataFrame, errors: DataFrame, bits: int | None = None, pairs: int = PAIRS) -> DataFrame:
    """Those ``keys.entity_key`` for which some ``original_row LIKE '%' || key || '%'`` holds.

    A substring test has no equality to join on, and comparing every key with
    every logged row would be a cross join. So rows are cut into pieces of up to
    ``GRAM`` characters, and a key is looked up by one of its own pieces:

    - a plain key of at most ``GRAM`` characters is its own piece; if a row has it, the key is found;
    - any other key takes the piece of its literal parts that stands in the fewest places of
      all rows, and LIKE verifies it on the rows that have that piece;
    - a key of wildcards alone needs only a row long enough.

    A piece is shuffled only if a Bloom filter of the pieces looked for holds it. ``bits`` is the filter's
    size, by default sized by the number of keys; beyond ``MOST_BITS`` it holds the beginnings of the pieces, so that more pieces pass, and
    the result is the same. Where a piece is common, so that its keys and rows make more than
    ``pairs`` pairs, its rows are dealt out to several tasks and its keys repeated in each.
    """
    # Both are read several times: the keys are made distinct once, the log is computed once.
    probes = tables.scratch(_probes(keys), "probes")
    rows = tables.scratch(errors.select("original_row").where(F.col("original_row").isNotNull()), "logged-rows")
    plain = (~F.col("wild")) & (F.length(F.get("literals", F.lit(0))) <= GRAM)
    has_literal = F.size("literals") > 0
    n_short, n_others = probes.agg(F.count_if(has_literal & plain), F.count_if(has_literal & ~plain)).first()

    longest_row = rows.agg(F.max(F.length("original_row"))).scalar()
    found = probes.where(~has_literal & (F.col("any_chars") <= longest_row)).select("entity_key")
    if n_short:
        short = probes.where(has_literal & plain).select("entity_key", F.get("literals", F.lit(0)).alias("gram"))
        pieces = pieces_in(rows, short.select("gram"), bits or _filter_bits(n_short)).distinct()
        found = found.unionByName(short.join(pieces, F.col("gram") == F.col("piece"), "left_semi").select("entity_key"))
    if n_others:
        others = probes.where(has_literal & ~plain)
        found = found.unionByName(_found_by_grams(others, rows, bits or _filter_bits(GRAM * n_others), pairs))
    return found


def _found_by_grams(probes: DataFrame, rows: DataFrame, bits: int, pairs: int) -> DataFrame:
    """The keys of ``probes`` that occur in ``rows``, looked up by their rarest grams and verified with LIKE."""
    chosen = tables.scratch(rarest_grams(probes, rows, bits), "rarest-grams")
    sizes = chosen.groupBy("gram").agg(F.count(F.lit(1)).alias("n_keys"), F.max("df").alias("df"))
    dealt = sizes.select(
        "gram", F.least(F.greatest(F.ceil(F.col("n_keys") * F.col("df") / pairs), F.lit(1)), F.col("df")).cast("int").alias("salts")
    )
    # The row a piece stands in goes along, for LIKE; its hash says which part of a common piece it belongs to.
    held = pieces_in(rows, dealt.select("gram"), bits, "original_row").distinct()
    salted_rows = held.join(dealt, F.col("piece") == F.col("gram")).select(
        "piece", F.pmod(F.xxhash64("original_row"), F.col("salts")).cast("int").alias("salt"), "original_row"
    )
    salted_keys = probes.join(chosen.select("entity_key", "gram"), "entity_key").join(dealt, "gram").select(
        "entity_key", "pattern", "gram", F.explode(F.expr("sequence(0, salts - 1)")).alias("salt_of")
    )
    matches = F.expr("gram = piece AND salt_of = salt AND original_row LIKE concat('%', pattern, '%')")
    return salted_keys.join(salted_rows, matches, "left_semi").select("entity_key").distinct()


def quarantine_by_text(frame: DataFrame, key: str, errors: DataFrame) -> DataFrame:
    """Keep rows whose key occurs in no ``errors.original_row``. Rows without a key stay."""
    bad = keys_found_in_rows(frame.select(F.col(key).alias("entity_key")), errors)
    return frame.join(bad, frame[key] == bad["entity_key"], "left_anti")
