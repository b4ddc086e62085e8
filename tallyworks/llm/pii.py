"""Personal data: generators propose spans, boosted trees judge them, a calibrated threshold selects.

Everything that touches documents is DataFrame expressions; no shuffle is
needed, because the candidates of a document stay in its row. The patterns start
a match only where a run of their characters begins (or where the last match
ended) and never give characters back, which finds the same matches as the
plain patterns in time linear in the text.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm.shared import documents, written

# The kinds in the order in which they are listed.
KINDS = ["email", "ip", "card", "phone"]

# The base patterns. Equal to [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+ and so on.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

# What the base patterns miss: written-out addresses, numbers without a plus sign.
WIDER = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+ ?(?:\[at\]|\(at\)) ?"
             r"[A-Za-z0-9-]{1,63}+(?: ?(?:\[dot\]|\(dot\)|\.) ?[A-Za-z0-9-]{1,63}+){1,8}+",
    "phone": r"(?<![0-9+().-])(?<![0-9+().-] )\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])",
}

PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
CONTEXT = 24         # code points before a span that its features see
BLOCK = 256
ROUNDS = 40          # boosted trees
RATE = 0.3
PRECISION = 0.99     # that the threshold must reach on the candidates kept for calibration

FEATURES = {  # feature: number of values; their product bounds the table that is gathered
    "kind": 4, "digits": 5, "separators": 4, "sound": 2, "before": 4, "after": 4, "hint": 2,
}


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: a lambda would compute an outer expression at every step."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running_sums(values: Column) -> Column:
    """Sums of all values up to each one. In blocks, so that long arrays are not copied at every step."""
    def sums(array: Column) -> Column:
        return F.aggregate(
            array, F.array().cast("array<bigint>"),
            lambda out, x: F.concat(out, F.array(F.coalesce(F.try_element_at(out, F.lit(-1)), F.lit(0)) + x)),
        )

    blocks = F.transform(
        F.sequence(F.lit(0), F.ceil(F.size(values) / BLOCK).cast("int") - 1),
        lambda i: sums(F.slice(values, i * BLOCK + 1, BLOCK)),
    )
    shifted = _let(blocks, lambda blocks: _let(
        sums(F.transform(blocks, lambda block: F.try_element_at(block, F.lit(-1)))),
        lambda offsets: F.flatten(F.transform(blocks, lambda block, i: _let(
            F.when(i > 0, F.get(offsets, i - 1)).otherwise(F.lit(0)),
            lambda offset: F.transform(block, lambda x: x + offset),
        ))),
    ))
    return F.when(F.size(values) > 0, shifted).otherwise(F.array().cast("array<bigint>"))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(text: Column) -> Column:
    """Whether the check digit fits; only for up to 19 digits."""
    def fits(digits: Column) -> Column:
        def add(out: Column, i: Column) -> Column:
            digit = F.substr(digits, i, F.lit(1)).try_cast("int")
            return out + F.when(i % 2 == 0, digit * 2 - F.when(digit > 4, 9).otherwise(0)).otherwise(digit)

        total = F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))), F.lit(0), add)
        return F.coalesce(total % 10 == 0, F.lit(False))

    return _let(F.reverse(_digits(text)), fits)


def _valid(kind: str, text: Column) -> Column:
    count = F.length(_digits(text))
    if kind == "ip":
        return text.rlike(rf"^{PART}(?:\.{PART}){{3}}$")
    if kind == "card":
        return F.when(count.between(14, 19), _luhn(text)).otherwise(F.lit(False))
    if kind == "phone":
        return count.between(10, 15)
    return F.lit(True)


def _char(text: Column) -> Column:
    """What stands beside a span: 0 nothing, 1 white space, 2 a letter or digit, 3 something else."""
    return (
        F.when(text == "", 0).when(text.rlike(r"^\s"), 1).when(text.rlike(r"^[\p{L}\p{N}]"), 2).otherwise(3)
    )


def _spans(gaps: Column, matches: Column, ends: Column, kind: str, is_base: bool) -> Column:
    """The matches of one pattern: ``array<struct<start, end, kind, base, ... features>>``.

    ``gaps`` is the text between the matches and ``ends`` where these end.
    """
    number = KINDS.index(kind)

    def span(match: Column, i: Column) -> Column:
        end = F.get(ends, i)
        before, after = F.get(gaps, i), F.get(gaps, i + 1)
        context = F.lower(F.right(before, F.lit(CONTEXT)))
        digits = F.length(_digits(match))
        return _let(_valid(kind, match), lambda valid: F.struct(
            (end - F.length(match)).alias("start"), end.alias("end"), F.lit(number).alias("kind"),
            (valid if is_base else F.lit(False)).alias("base"),
            # a match of a base pattern teaches the trees, one of a wider pattern only asks them
            F.lit(is_base).alias("teaches"),
            F.when(digits < 9, 0).when(digits < 12, 1).when(digits < 14, 2).when(digits < 20, 3).otherwise(4)
            .alias("digits"),
            F.least(F.length(F.regexp_replace(match, r"[A-Za-z0-9]", "")), F.lit(3)).alias("separators"),
            (valid.cast("int") if is_base or kind != "email" else F.lit(1)).alias("sound"),
            _char(F.right(before, F.lit(1))).alias("before"),
            _char(F.left(after, F.lit(1))).alias("after"),
            context.rlike(r"mail|phone|call|tel|card|visa|contact|addr|host|ip\b").cast("int").alias("hint"),
        ))

    spans = F.transform(matches, span)
    if kind in ("card", "phone"):  # most numbers are far too short for either
        spans = F.filter(spans, lambda s: s["base"] | (s["digits"] > 0))
    return spans


def candidates(docs: DataFrame, id_column: str, text_column: str, whole: bool = False) -> DataFrame:
    """``(id, found)``, whatever the id was called: all proposed spans of each document, overlapping or not.

    With ``whole``, ``row`` beside them holds the document's columns.
    """
    row = [F.struct(*docs.columns).alias("row")] if whole else []
    kept = ["id", *(["row"] if whole else [])]
    generators = [(kind, BASE[kind], True) for kind in KINDS] + [(kind, WIDER[kind], False) for kind in WIDER]
    cut = docs.select(F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("text"), *row).select(
        *kept,
        *[F.split("text", pattern, -1).alias(f"gaps_{i}") for i, (_, pattern, _) in enumerate(generators)],
        *[F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias(f"matches_{i}")
          for i, (_, pattern, _) in enumerate(generators)],
    )
    placed = cut.select("*", *[
        _running_sums(F.zip_with(
            F.slice(f"gaps_{i}", F.lit(1), F.size(f"matches_{i}")), f"matches_{i}",
            lambda a, b: (F.length(a) + F.length(b)).cast("bigint"),
        )).alias(f"ends_{i}") for i in range(len(generators))
    ])
    return placed.select(*kept, F.concat(*[
        _spans(F.col(f"gaps_{i}"), F.col(f"matches_{i}"), F.col(f"ends_{i}"), kind, is_base)
        for i, (kind, _, is_base) in enumerate(generators)
    ]).alias("found"))


class BoostedTrees:
    """Trees of two splits on small whole numbers, fitted by Newton steps to counts of cases.

    The cases are given as distinct feature values with their numbers, so the fit
    handles at most the product of the features' sizes, whatever the corpus.
    """

    def __init__(self, sizes: dict[str, int], rounds: int = ROUNDS, rate: float = RATE):
        self.sizes, self.rounds, self.rate = sizes, rounds, rate
        self.start = 0.0
        self.trees: list[tuple] = []

    def fit(self, cases: list[tuple[dict[str, int], float, float]]) -> BoostedTrees:
        """``cases``: features, number of cases, number of them that are positive."""
        total, positive = sum(c[1] for c in cases), sum(c[2] for c in cases)
        if not total:
            return self
        self.start = math.log((positive + 0.5) / (total - positive + 0.5))
        margins = [self.start] * len(cases)
        for _ in range(self.rounds):
            slopes = []
            for (_, n, good), margin in zip(cases, margins):
                p = 1 / (1 + math.exp(-margin))
                slopes.append((good - n * p, max(n * p * (1 - p), 1e-9)))
            tree = self._grow(cases, slopes, list(range(len(cases))), 2)
            self.trees.append(tree)
            margins = [m + self._value(tree, c[0]) for m, c in zip(margins, cases)]
        return self

    def _grow(self, cases, slopes, members, depth):
        g, h = sum(slopes[i][0] for i in members), sum(slopes[i][1] for i in members)
        best = None
        if depth:
            for name, size in self.sizes.items():
                by_value = [[0.0, 0.0] for _ in range(size)]
                for i in members:
                    cell = by_value[cases[i][0][name]]
                    cell[0] += slopes[i][0]
                    cell[1] += slopes[i][1]
                left_g = left_h = 0.0
                for cut in range(1, size):
                    left_g, left_h = left_g + by_value[cut - 1][0], left_h + by_value[cut - 1][1]
                    gain = left_g**2 / (left_h + 1) + (g - left_g)**2 / (h - left_h + 1) - g * g / (h + 1)
                    if gain > 1e-6 and (best is None or gain > best[0]):
                        best = (gain, name, cut)
        if best is None:
            return (self.rate * g / (h + 1),)
        _, name, cut = best
        low = [i for i in members if cases[i][0][name] < cut]
        high = [i for i in members if cases[i][0][name] >= cut]
        return (name, cut, self._grow(cases, slopes, low, depth - 1), self._grow(cases, slopes, high, depth - 1))

    def _value(self, tree, features) -> float:
        while len(tree) > 1:
            tree = tree[2] if features[tree[0]] < tree[1] else tree[3]
        return tree[0]

    def score(self, features: dict[str, int]) -> float:
        return 1 / (1 + math.exp(-self.start - sum(self._value(tree, features) for tree in self.trees)))


def fit(found: DataFrame) -> tuple[BoostedTrees, float]:
    """Trees and threshold from the candidates of the base patterns, as those patterns judge them.

    Half of the documents teach the trees, the others calibrate: the threshold
    is the lowest score from which on the share of right ones is ``PRECISION``.
    """
    names = list(FEATURES)
    half = F.pmod(F.xxhash64("id"), F.lit(2)).alias("half")
    table = (
        found.select(half, F.explode("found").alias("s")).where("s.teaches")
        .groupBy("half", *[F.col(f"s.{n}").alias(n) for n in names])
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("s.base").alias("good"))
        .collect()  # at most 2 x the product of FEATURES
    )
    cases = [[], []]
    for row in table:
        cases[row["half"]].append(({n: row[n] for n in names}, row["n"], row["good"]))
    model = BoostedTrees(FEATURES).fit(cases[0])
    seen = total = 0
    threshold = 0.5
    for score, n, good in sorted(((model.score(f), n, good) for f, n, good in cases[1]), reverse=True):
        seen, total = seen + good, total + n
        if seen >= PRECISION * total:
            threshold = min(0.5, score)
    return model, max(threshold, 0.05)


def _accepted(model: BoostedTrees, threshold: float):
    """The trees as a table of accepted feature values: one look-up for a candidate."""
    names = list(FEATURES)
    accepted = [
        values for values in product(*(range(FEATURES[n]) for n in names))
        if model.score(dict(zip(names, values))) >= threshold
    ]
    codes = sorted(_code(dict(zip(names, values))) for values in accepted)
    ranges: list[list[int]] = []
    for code in codes:
        if ranges and ranges[-1][1] == code - 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])

    def test(span: Column) -> Column:
        code = reduce(lambda out, n: out * FEATURES[n] + span[n], names, F.lit(0))
        table = F.array(*[F.array(F.lit(a), F.lit(b)) for a, b in ranges]) if ranges else None
        return F.exists(table, lambda r: code.between(r[0], r[1])) if ranges else F.lit(False)

    return test


def _code(values: dict[str, int]) -> int:
    return reduce(lambda out, n: out * FEATURES[n] + values[n], FEATURES, 0)


def _overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def detect(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, base, spans)``: the spans of each row as ``array<struct<start, end, kind>>`` by start, then kind.

    ``base`` are the valid matches of the base patterns; ``spans`` adds those
    proposed spans that the trees accept and that overlap no other one. A null
    text counts as empty, an empty one has no spans. Repeated rows are judged
    alike; columns other than the two are not read, whatever their names. With
    no candidates at all, nothing is learnt and nothing added.
    """
    spans = _judged(written(candidates(docs, id_column, text_column), "pii-candidates"))
    return spans.select(F.col("id").alias(id_column), "base", "spans")


def _judged(found: DataFrame) -> DataFrame:
    """The candidates' ``base`` and ``spans`` in place of ``found``; see ``detect``."""
    model, threshold = fit(found)
    accept = _accepted(model, threshold)
    kept = [c for c in found.columns if c != "found"]
    judged = found.select(
        *kept, F.filter("found", lambda s: s["base"]).alias("base"),
        F.filter("found", lambda s: ~s["teaches"] & accept(s)).alias("wider"),
    )
    more = F.filter("wider", lambda s: ~F.exists("base", lambda b: _overlap(s, b)))
    # of wider spans that overlap, the one that begins first stays
    one = F.filter("more", lambda s: ~F.exists("more", lambda o: _overlap(s, o) & (
        F.struct(o["start"], o["end"], o["kind"]) < F.struct(s["start"], s["end"], s["kind"]))))
    plain = lambda spans: F.array_sort(F.transform(
        spans, lambda s: F.struct(s["start"], s["kind"], s["end"])))
    return judged.select(*kept, "base", more.alias("more")).select(
        *kept, plain("base").alias("base"), plain(F.concat("base", one)).alias("spans")
    )


def _named(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    ), ",")


def redact(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows with every span replaced by its kind, as in ``[email]``; where spans overlap, by the first one's.

    All columns stay, in order. A null text stays null. A row carries its own spans,
    so ids may be null or repeated.
    """
    found = written(candidates(docs, id_column, text_column, whole=True), "pii-rows")
    joined = _judged(found).select("row.*", F.col("spans").alias("_spans"))
    names = F.array(*map(F.lit, KINDS))
    # sweep over the spans: keep what lies between them
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("upto"))
    swept = F.aggregate(
        "_spans", start,
        lambda at, s: F.struct(
            F.when(s["start"] >= at["upto"], F.concat(
                at["out"], F.substr(F.col(text_column), (at["upto"] + 1).cast("int"), (s["start"] - at["upto"]).cast("int")),
                F.lit("["), F.get(names, s["kind"]), F.lit("]"),
            )).otherwise(at["out"]).alias("out"),
            F.greatest(at["upto"], s["end"]).alias("upto"),
        ),
        lambda at: F.concat(at["out"], F.substr(F.col(text_column), (at["upto"] + 1).cast("int"))),
    )
    text = F.when(F.size("_spans") == 0, F.col(text_column)).otherwise(swept)
    return joined.select(*[text.alias(c) if c == text_column else F.col(c) for c in docs.columns])


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = detect(documents(spark, folder))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(_named("base"), 256).alias("base_sha256"), _named("spans").alias("spans"),
    )
